"""Signature rules of license scans, written by hand.

One rule a line: label, tier, keyword, ``::``, and a regular expression over words in
lower case with one blank between them. The keyword (``_`` stands for a blank) is
part of every text that the expression matches; only where it occurs is the
expression tried. Tiers, from weak to strong: 1 mention, 2 name or address, 3 grant,
4 wording of the license or its notice, 5 machine-readable tag. Within a tier
earlier lines come first.

An expression starts and ends with a word, and matches whole words only. Both Java's
and RE2's syntax must take it, so there is no look-around and no back reference.
"""

from __future__ import annotations

from dataclasses import dataclass

#: The base phrases, whose labels always stay.
BASE = """
mit       3 mit_license            :: under the mit license
apache-2  2 apache_license_version :: apache license version 2
cc-by-nc  2 cc_by_nc               :: cc by nc
"""

SIGNATURES = """
mit 5 license_identifier_mit :: spdx license identifier mit
mit 4 person_obtaining_a_copy :: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 4 this_permission_notice :: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit 4 to_deal_in_the_software :: to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
mit 3 mit_license :: (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?mit license
mit 3 mit_license :: subject to (?:the terms of )?the mit license
mit 2 org_licenses_mit :: opensource org licenses mit(?: license)?
mit 2 licenses_mit :: spdx org licenses mit
mit 2 mit_licen :: mit licen(?:se|ce|sed|ced)
mit 2 mit_x11 :: mit x11 licen[cs]e
mit 2 mit_expat :: mit expat(?: licen[cs]e)?
mit 2 expat_licen :: expat licen[cs]e
mit 2 licen :: licen[cs]e mit
mit-0 5 license_identifier_mit_0 :: spdx license identifier mit 0
mit-0 2 mit_no_attribution :: mit no attribution(?: licen[cs]e)?
mit-0 2 licenses_mit_0 :: spdx org licenses mit 0
mit-modern 5 license_identifier_mit_modern :: spdx license identifier mit modern variant
x11 5 license_identifier_x11 :: spdx license identifier x11
x11 4 name_of_the_x_consortium :: except as contained in this notice the name of the x consortium shall not be used in advertising
x11 2 x11_licen :: x11 licen[cs]e
apache-2 5 license_identifier_apache_2 :: spdx license identifier apache 2 0
apache-2 4 apache_license_version_2 :: licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2 4 you_may_not_use_this_file :: you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0
apache-2 4 without_warranties_or_conditions :: distributed on an as is basis without warranties or conditions of any kind either express or implied see the license
apache-2 3 apache_license :: (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?apache license (?:version |v)?2(?: 0)?
apache-2 2 apache_org_licenses :: apache org licenses license 2 0(?: html| txt)?
apache-2 2 org_licenses_apache_2 :: (?:opensource|spdx) org licenses apache 2 0
apache-2 2 apache_license :: apache license (?:version |v)?2 0
apache-2 2 apache_2 :: apache 2 0 licen(?:se|ce|sed|ced)
apache-2 2 apache_software_license :: apache software license (?:version |v)?2 0
apache-2 2 apache_v2 :: apache v2(?: 0)?(?: licen[cs]e)?
apache-2 2 asl_2 :: asl 2 0
apache-1.1 5 license_identifier_apache_1 :: spdx license identifier apache 1 1
apache-1.1 4 apache_software_foundation :: this product includes software developed by the apache software foundation http www apache org
apache-1.1 2 apache :: apache (?:software )?license (?:version |v)?1 1
apache-1.0 5 license_identifier_apache_1 :: spdx license identifier apache 1 0
apache-1.0 4 the_apache_group :: this product includes software developed by the apache group for use in the apache http server project
apache-1.0 2 apache :: apache (?:software )?license (?:version |v)?1 0
apache 1 apache_licen :: apache licen(?:se|ce|sed|ced)
apache 1 apache_software_license :: apache software license
bsd-2 5 license_identifier_bsd_2 :: spdx license identifier bsd 2 clause(?: freebsd| netbsd)?
bsd-2 2 bsd_2_clause :: bsd 2 clause(?: licen[cs]e)?
bsd-2 2 2_clause_bsd :: 2 clause bsd(?: licen[cs]e)?
bsd-2 2 simplified_bsd :: simplified bsd licen[cs]e
bsd-2 2 freebsd_licen :: freebsd licen[cs]e
bsd-2 2 org_licenses_bsd_2 :: opensource org licenses bsd 2 clause
bsd-3 5 license_identifier_bsd_3 :: spdx license identifier bsd 3 clause
bsd-3 4 endorse_or_promote :: may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3 2 bsd_3_clause :: bsd 3 clause(?: licen[cs]e)?
bsd-3 2 3_clause_bsd :: 3 clause bsd(?: licen[cs]e)?
bsd-3 2 new_bsd :: new bsd licen[cs]e
bsd-3 2 modified_bsd :: modified bsd licen[cs]e
bsd-3 2 revised_bsd :: revised bsd licen[cs]e
bsd-3 2 org_licenses_bsd_3 :: opensource org licenses bsd 3 clause
bsd-4 5 license_identifier_bsd_4 :: spdx license identifier bsd 4 clause(?: uc)?
bsd-4 4 all_advertising_materials :: all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd-4 2 bsd_4_clause :: bsd 4 clause(?: licen[cs]e)?
bsd-4 2 original_bsd :: original bsd licen[cs]e
bsd-0 5 license_identifier_0bsd :: spdx license identifier 0bsd
bsd-0 2 zero_clause_bsd :: zero clause bsd(?: licen[cs]e)?
bsd 4 redistribution_and_use_in_source :: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd 4 redistributions_of_source_code :: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd 4 redistributions_in_binary_form :: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd 3 bsd :: (?:licensed|released|distributed|available) under (?:a |the )?(?:terms of the )?bsd(?: style)? licen[cs]e
bsd 1 bsd_licen :: bsd licen(?:se|ce|sed|ced)
bsd 1 bsd_style :: bsd style licen[cs]e
gpl-1 5 license_identifier_gpl_1 :: spdx license identifier gpl 1 0(?: only| or later)?
gpl-2-or-later 5 license_identifier_gpl_2 :: spdx license identifier gpl 2 0 or later
gpl-2 5 license_identifier_gpl_2 :: spdx license identifier gpl 2 0(?: only)?
gpl-3-or-later 5 license_identifier_gpl_3 :: spdx license identifier gpl 3 0 or later
gpl-3 5 license_identifier_gpl_3 :: spdx license identifier gpl 3 0(?: only)?
gpl-2-or-later 4 general_public_license_as_published :: gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3-or-later 4 general_public_license_as_published :: gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2 4 public_license_version_2 :: gnu general public license version 2 as published by the free software foundation
gpl-2 4 gnu_general_public :: terms of the gnu general public license version 2
gpl-2 4 general_public :: gnu general public license version 2 june 1991
gpl-3 4 general_public :: gnu general public license version 3 29 june 2007
gpl-2-or-later 3 public_licen :: gnu general public licen[cs]e (?:version |v)?2(?: 0)? or (?:any )?later(?: version)?
gpl-3-or-later 3 public_licen :: gnu general public licen[cs]e (?:version |v)?3(?: 0)? or (?:any )?later(?: version)?
gpl-3 3 gnu_general_public :: (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)?3(?: 0)?
gpl-2 3 gnu_general_public :: (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v)?2(?: 0)?
gpl-1 2 general_public_licen :: (?:gnu )?general public licen[cs]e (?:version |v)?1(?: 0)?
gpl-2 2 general_public_licen :: (?:gnu )?general public licen[cs]e (?:version |v)?2(?: 0)?
gpl-3 2 general_public_licen :: (?:gnu )?general public licen[cs]e (?:version |v)?3(?: 0)?
gpl-2 2 licenses_gpl_2 :: gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
gpl-2 2 org_licenses_old_licenses_gpl_2 :: gnu org licenses old licenses gpl 2 0
gpl-3 2 org_licenses_gpl_3 :: gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-2 2 gpl :: (?:gnu )?gpl ?(?:version )?v?2(?: 0)?(?: only)?
gpl-3 2 gpl :: (?:gnu )?gpl ?(?:version )?v?3(?: 0)?(?: only)?
gpl-2-or-later 2 gplv2_or_later :: (?:gnu )?gplv2 or later
gpl-3-or-later 2 gplv3_or_later :: (?:gnu )?gplv3 or later
gpl-2 2 gplv2 :: (?:gnu )?gplv2
gpl-3 2 gplv3 :: (?:gnu )?gplv3
gpl 4 free_software_you_can_redistribute :: (?:this program|it) is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl 2 org_licenses_gpl :: gnu org licenses gpl(?: html| txt)?
gpl 1 gnu_general_public :: gnu general public licen[cs]e
gpl 1 gnu_gpl :: gnu gpl
gpl 1 gpl_licen :: gpl licen(?:se|ce|sed|ced)
gpl-classpath 5 classpath_exception :: gpl 2 0(?: only| or later)? with classpath exception 2 0
gpl-classpath 2 classpath_exception :: (?:gnu )?classpath exception
gpl-linking 4 special_exception_to_the_gnu :: as a special exception to the gnu general public license
lgpl-2 5 license_identifier_lgpl_2_0 :: spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 5 license_identifier_lgpl_2_1 :: spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3 5 license_identifier_lgpl_3 :: spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1 4 general_public_license_as_published :: gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3 4 general_public_license_as_published :: gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2 4 gnu_library_general_public :: terms of the gnu library general public license
lgpl-2 2 library_general_public :: (?:gnu )?library general public licen[cs]e (?:version |v)?2(?: 0)?
lgpl-2.1 2 lesser_general_public :: (?:gnu )?lesser general public licen[cs]e (?:version |v)?2 1
lgpl-3 2 lesser_general_public :: (?:gnu )?lesser general public licen[cs]e (?:version |v)?3(?: 0)?
lgpl-2.1 2 org_licenses_ :: gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 2 org_licenses_lgpl_3 :: gnu org licenses lgpl 3 0
lgpl-2.1 2 lgpl :: (?:gnu )?lgpl ?(?:version )?v?2 1
lgpl-3 2 lgpl :: (?:gnu )?lgpl ?(?:version )?v?3(?: 0)?
lgpl 4 lesser_general_public :: redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl 1 lesser_general_public :: (?:gnu )?lesser general public licen[cs]e
lgpl 1 gnu_lgpl :: gnu lgpl
agpl-3 5 license_identifier_agpl_3 :: spdx license identifier agpl 3 0(?: only| or later)?
agpl-3 4 general_public_license_as_published :: gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3 2 affero_general_public :: (?:gnu )?affero general public licen[cs]e (?:version |v)?3(?: 0)?
agpl-3 2 org_licenses_agpl_3 :: gnu org licenses agpl 3 0
agpl-3 2 agpl :: (?:gnu )?agpl ?(?:version )?v?3(?: 0)?
agpl-3 2 agplv3 :: (?:gnu )?agplv3
agpl-1 5 license_identifier_agpl_1 :: spdx license identifier agpl 1 0(?: only| or later)?
agpl 1 affero_general_public :: (?:gnu )?affero general public licen[cs]e
gfdl-1.1 5 license_identifier_gfdl_1_1 :: spdx license identifier gfdl 1 1(?: only| or later)?
gfdl-1.2 5 license_identifier_gfdl_1_2 :: spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.3 5 license_identifier_gfdl_1_3 :: spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.2 2 free_documentation_licen :: gnu free documentation licen[cs]e (?:version |v)?1 2
gfdl-1.3 2 free_documentation_licen :: gnu free documentation licen[cs]e (?:version |v)?1 3
gfdl 4 no_invariant_sections :: with no invariant sections no front cover texts and no back cover texts
gfdl 1 free_documentation_licen :: (?:gnu )?free documentation licen[cs]e
mpl-1.0 5 license_identifier_mpl_1_0 :: spdx license identifier mpl 1 0
mpl-1.1 5 license_identifier_mpl_1_1 :: spdx license identifier mpl 1 1
mpl-2 5 license_identifier_mpl_2 :: spdx license identifier mpl 2 0(?: no copyleft exception)?
mpl-2 4 mozilla_public_license_v_2 :: this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 4 mozilla_public_license_version_1_1 :: the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1 2 mozilla_public_licen :: mozilla public licen[cs]e (?:version |v ?)?1 1
mpl-1.0 2 mozilla_public_licen :: mozilla public licen[cs]e (?:version |v ?)?1 0
mpl-2 2 mozilla_public_licen :: mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?
mpl-2 2 mozilla_org_mpl_2 :: mozilla org mpl 2 0
mpl-1.1 2 mozilla_org_mpl_mpl_1 :: mozilla org mpl mpl 1 1(?: html)?
mpl-2 2 mpl_2 :: mpl 2 0
mpl-1.1 2 mpl_1_1 :: mpl 1 1
mpl 1 mozilla_public_licen :: mozilla public licen[cs]e
npl-1.1 2 netscape_public_licen :: netscape public licen[cs]e(?: version 1 [01])?
epl-1 5 license_identifier_epl_1 :: spdx license identifier epl 1 0
epl-2 5 license_identifier_epl_2 :: spdx license identifier epl 2 0
epl-1 4 eclipse_public_license_v1 :: made available under the terms of the eclipse public license v1 0
epl-2 4 eclipse_public_license :: made available under the terms of the eclipse public license (?:v )?2 0
epl-1 2 eclipse_public_licen :: eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?
epl-2 2 eclipse_public_licen :: eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?
epl-1 2 eclipse_org_legal_epl_v10 :: eclipse org legal epl v10(?: html)?
epl-2 2 eclipse_org_legal_epl_ :: eclipse org legal epl (?:v20|2 0)
epl 1 eclipse_public_licen :: eclipse public licen[cs]e
edl-1 2 eclipse_distribution_licen :: eclipse distribution licen[cs]e(?: (?:version |v ?)?1 0)?
cddl-1 5 license_identifier_cddl_1 :: spdx license identifier cddl 1 [01]
cddl-1 4 common_development_and_distribution :: subject to the terms of the common development and distribution license
cddl-1 2 common_development_and_distribution :: common development and distribution licen[cs]e(?: (?:version |v)?1 [01])?
cddl-1 2 cddl_1 :: cddl 1 [01]
cpl-1 2 common_public_licen :: common public licen[cs]e(?: (?:version |v)?1 0)?
cpal-1 2 common_public_attribution :: common public attribution licen[cs]e(?: (?:version )?1 0)?
ipl-1 2 ibm_public_licen :: ibm public licen[cs]e(?: (?:version )?1 0)?
isc 5 license_identifier_isc :: spdx license identifier isc
isc 4 permission_to_use_copy_modify :: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 2 isc_licen :: isc licen(?:se|ce|sed|ced)
isc 2 org_licenses_isc :: opensource org licenses isc(?: license)?
hpnd 4 permission_to_use_copy_modify :: permission to use copy modify and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted
ntp 2 ntp_licen :: ntp licen[cs]e
zlib 5 license_identifier_zlib :: spdx license identifier zlib
zlib 4 origin_of_this_software :: the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib 4 altered_source_versions :: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib 2 zlib :: zlib (?:libpng )?licen[cs]e
libpng 2 libpng_licen :: libpng licen[cs]e
boost-1 5 license_identifier_bsl_1 :: spdx license identifier bsl 1 0
boost-1 4 boost_software_license :: distributed under the boost software license version 1 0
boost-1 2 boost_software_licen :: boost software licen[cs]e(?: (?:version )?1 0)?
boost-1 2 boost_org_license_1_0 :: boost org license 1 0(?: txt)?
unlicense 5 license_identifier_unlicense :: spdx license identifier unlicense
unlicense 4 unencumbered_software :: this is free and unencumbered software released into the public domain
unlicense 2 unlicense_org :: unlicense org
unlicense 2 the_unlicense :: the unlicense
wtfpl 5 license_identifier_wtfpl :: spdx license identifier wtfpl
wtfpl 2 public_licen :: do what the f(?:uck|k) you want to public licen[cs]e
wtfpl 2 wtfpl :: wtfpl(?: version 2)?
artistic-1 5 license_identifier_artistic_1 :: spdx license identifier artistic 1 0(?: perl| cl8)?
artistic-2 5 license_identifier_artistic_2 :: spdx license identifier artistic 2 0
artistic-1 2 artistic_licen :: artistic licen[cs]e (?:version )?1 0
artistic-2 2 artistic_licen :: (?:the )?artistic licen[cs]e (?:version )?2(?: 0)?
artistic 1 artistic_licen :: artistic licen[cs]e
perl 4 same_terms_as_perl :: (?:under the )?same terms as perl itself
python-2 5 license_identifier_python_2 :: spdx license identifier python 2 0(?: 1)?
python-2 2 python_software_foundation_licen :: python software foundation licen[cs]e(?: version 2)?
python-2 2 psf_licen :: psf licen[cs]e
ruby 2 ruby_licen :: ruby licen[cs]e
php-3 2 php_licen :: php licen[cs]e(?: (?:version |v)?3 0[01]?)?
postgresql 5 license_identifier_postgresql :: spdx license identifier postgresql
postgresql 2 postgresql_licen :: postgresql licen[cs]e
openssl 5 license_identifier_openssl :: spdx license identifier openssl
openssl 4 developed_by_the_openssl_project :: this product includes software developed by the openssl project for use in the openssl toolkit
openssl 2 openssl_licen :: openssl licen[cs]e
curl 5 license_identifier_curl :: spdx license identifier curl
ofl-1.1 5 license_identifier_ofl_1 :: spdx license identifier ofl 1 1(?: rfn| no rfn)?
ofl-1.1 4 font_software_is_licensed :: this font software is licensed under the sil open font license version 1 1
ofl-1.1 2 open_font_licen :: (?:sil )?open font licen[cs]e(?: (?:version |v)?1 1)?
ofl-1.1 2 scripts_sil_org_ofl :: scripts sil org ofl
osl-3 5 license_identifier_osl_3 :: spdx license identifier osl 3 0
osl-3 2 open_software_licen :: open software licen[cs]e (?:version |v ?)?3 0
afl-3 5 license_identifier_afl_3 :: spdx license identifier afl 3 0
afl-3 2 academic_free_licen :: academic free licen[cs]e(?: (?:version |v ?)?3 0)?
ecl-2 2 educational_community_licen :: educational community licen[cs]e(?: (?:version )?2 0)?
eupl-1.1 5 license_identifier_eupl_1_1 :: spdx license identifier eupl 1 1
eupl-1.2 5 license_identifier_eupl_1_2 :: spdx license identifier eupl 1 2
eupl-1.1 2 european_union_public_licen :: european union public licen[cs]e (?:version |v ?)?1 1
eupl-1.2 2 european_union_public_licen :: european union public licen[cs]e (?:version |v ?)?1 2
eupl 1 european_union_public_licen :: european union public licen[cs]e
cecill-2 2 cecill :: cecill(?: free software licen[cs]e)?(?: (?:version |v)?2(?: [01])?)?
ms-pl 5 license_identifier_ms_pl :: spdx license identifier ms pl
ms-pl 2 microsoft_public_licen :: microsoft public licen[cs]e(?: ms pl)?
ms-rl 2 microsoft_reciprocal_licen :: microsoft reciprocal licen[cs]e(?: ms rl)?
ncsa 5 license_identifier_ncsa :: spdx license identifier ncsa
ncsa 2 ncsa_open_source :: (?:university of illinois )?ncsa open source licen[cs]e
w3c 2 w3c_software :: w3c software (?:notice and )?(?:and document )?licen[cs]e
upl-1 2 universal_permissive_licen :: universal permissive licen[cs]e(?: (?:version |v ?)?1 0)?
blueoak-1 2 blue_oak_model_licen :: blue oak model licen[cs]e(?: 1 0 0)?
bsl-1.1 5 license_identifier_busl :: spdx license identifier busl 1 1
bsl-1.1 2 business_source_licen :: business source licen[cs]e(?: (?:version )?1 1)?
sspl-1 5 license_identifier_sspl :: spdx license identifier sspl 1 0
sspl-1 2 server_side_public_licen :: server side public licen[cs]e(?: (?:version |v ?)?1)?
elastic-2 2 elastic_licen :: elastic licen[cs]e(?: (?:version )?2 0)?
commons-clause 2 commons_clause :: commons clause(?: licen[cs]e condition)?
polyform-nc 2 polyform_noncommercial :: polyform noncommercial licen[cs]e(?: 1 0 0)?
cc0-1 5 license_identifier_cc0 :: spdx license identifier cc0 1 0
cc0-1 4 dedicated_the_work_to_the_public_domain :: has dedicated the work to the public domain by waiving all of his or her rights
cc0-1 2 publicdomain_zero :: creativecommons org publicdomain zero 1 0
cc0-1 2 cc0 :: cc0(?: 1 0)?(?: universal)?
cc0-1 2 creative_commons_zero :: creative commons zero(?: v?1 0)?(?: universal)?
cc-by 5 license_identifier_cc_by :: spdx license identifier cc by [1234] [05]
cc-by-sa 5 license_identifier_cc_by_sa :: spdx license identifier cc by sa [1234] [05]
cc-by-nd 5 license_identifier_cc_by_nd :: spdx license identifier cc by nd [1234] [05]
cc-by-nc 5 license_identifier_cc_by_nc :: spdx license identifier cc by nc [1234] [05]
cc-by-nc-sa 5 license_identifier_cc_by_nc_sa :: spdx license identifier cc by nc sa [1234] [05]
cc-by-nc-nd 5 license_identifier_cc_by_nc_nd :: spdx license identifier cc by nc nd [1234] [05]
cc-by-nc-sa 3 cc_by_nc_sa :: (?:licensed|released|distributed|available) under (?:the )?cc by nc sa(?: [1234] [05])?
cc-by-nc-nd 3 cc_by_nc_nd :: (?:licensed|released|distributed|available) under (?:the )?cc by nc nd(?: [1234] [05])?
cc-by-nc 3 cc_by_nc :: (?:licensed|released|distributed|available) under (?:the )?cc by nc(?: [1234] [05])?
cc-by-sa 3 cc_by_sa :: (?:licensed|released|distributed|available) under (?:the )?cc by sa(?: [1234] [05])?
cc-by-nd 3 cc_by_nd :: (?:licensed|released|distributed|available) under (?:the )?cc by nd(?: [1234] [05])?
cc-by 3 cc_by :: (?:licensed|released|distributed|available) under (?:the )?cc by(?: [1234] [05])?
cc-by-nc-sa 2 cc_by_nc_sa :: cc by nc sa(?: [1234] [05])?
cc-by-nc-nd 2 cc_by_nc_nd :: cc by nc nd(?: [1234] [05])?
cc-by-sa 2 cc_by_sa :: cc by sa(?: [1234] [05])?
cc-by-nd 2 cc_by_nd :: cc by nd(?: [1234] [05])?
cc-by 2 cc_by_ :: cc by [1234] [05]
cc-by-nc-sa 2 org_licenses_by_nc_sa :: creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-nd 2 org_licenses_by_nc_nd :: creativecommons org licenses by nc nd [1234] [05]
cc-by-nc 2 org_licenses_by_nc :: creativecommons org licenses by nc [1234] [05]
cc-by-sa 2 org_licenses_by_sa :: creativecommons org licenses by sa [1234] [05]
cc-by-nd 2 org_licenses_by_nd :: creativecommons org licenses by nd [1234] [05]
cc-by 2 org_licenses_by_ :: creativecommons org licenses by [1234] [05]
cc-by-nc-sa 2 creative_commons_attribution_non :: creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?
cc-by-nc-nd 2 creative_commons_attribution_non :: creative commons attribution non ?commercial no ?derivatives(?: [1234] [05])?(?: international| unported| generic)?
cc-by-nc 2 creative_commons_attribution_non :: creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?
cc-by-sa 2 creative_commons_attribution_share :: creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?
cc-by-nd 2 creative_commons_attribution_no :: creative commons attribution no ?derivatives(?: [1234] [05])?(?: international| unported| generic)?
cc-by 2 creative_commons_attribution :: creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?
cc 1 creative_commons_licen :: creative commons licen[cs]e
odbl-1 2 open_database_licen :: open database licen[cs]e(?: (?:version |v)?1 0)?
odc-by-1 2 open_data_commons_attribution :: open data commons attribution licen[cs]e(?: (?:version |v)?1 0)?
pddl-1 2 public_domain_dedication :: (?:open data commons )?public domain dedication and licen[cs]e(?: 1 0)?
ogl-3 2 open_government_licen :: open government licen[cs]e(?: (?:version |v ?)?[123](?: 0)?)?
openrail-m 2 openrail :: (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?
public-domain 3 public_domain :: (?:placed|released|dedicated) (?:in|into|to) the public domain
public-domain 1 in_the_public_domain :: (?:is|are) in the public domain
proprietary 3 all_rights_reserved :: proprietary and confidential all rights reserved
proprietary 3 unauthorized_copying :: unauthorized copying of this file via any medium is strictly prohibited
non-commercial 3 commercial :: for non ?commercial (?:use|purposes) only
other-license 1 license_identifier :: spdx license identifier (?:license ?ref )?[0-9a-z]+
other-license 1 see_the_license_file :: see the license file(?: for details| in the project root)?
"""


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    tier: int
    keyword: str
    pattern: str
    base: bool


def _parsed(lines: str, base: bool) -> list[tuple]:
    out = []
    for line in lines.strip().split("\n"):
        head, pattern = line.split(" :: ")
        label, tier, keyword = head.split()
        out.append((label, int(tier), keyword.replace("_", " "), pattern.strip(), base))
    return out


#: Base phrases come first; a rule's number is its place.
RULES = [Rule(k, *found) for k, found in enumerate([*_parsed(BASE, True), *_parsed(SIGNATURES, False)])]
