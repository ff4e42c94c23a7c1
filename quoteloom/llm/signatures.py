"""Hand-written signatures of license texts and of names in passing.

Fixed values: each row is (label, confidence, gate, expression over words).  A gate lists the
phrases of which every match has one; a row that is a plain phrase needs none.  The more
specific stands before the more general.
"""

from __future__ import annotations

# What the texts and notices of licenses say; taken before any name.
TEXTS = (
    # MIT and its relatives
    ("bsl-1", 0.95, "", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("mit", 0.95, "", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 0.9, "", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 0.9, "", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("x11", 0.9, "except as contained in this notice", r"except as contained in this notice the names? of .{1,80} shall not be used in advertising or otherwise to promote the sale use or other dealings"),
    ("json", 0.95, "", "the software shall be used for good not evil"),
    ("hpnd", 0.9, "its documentation for any purpose", r"permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and without fee )?is hereby granted without fee"),
    ("postgresql", 0.95, "", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("isc", 0.95, "this software for any purpose with or without fee is hereby granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", 0.95, "this software for any purpose with or without fee is hereby granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("ncsa", 0.95, "open source license", r"university of illinois (?:ncsa )?open source license"),
    ("curl", 0.9, "curl|daniel stenberg", r"curl licen[cs]e|copyright and permission notice copyright .{1,40} daniel stenberg"),
    ("mit-modern", 0.9, "", "permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute this software"),
    ("icu", 0.9, "", "provided that the above copyright notices and this permission notice appear in all copies of the software and that both the above copyright notices"),
    ("unicode", 0.9, "unicode", r"unicode (?:inc )?licen[cs]e(?: agreement)?|permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    # BSD
    ("bsd-4-clause", 0.95, "all advertising materials mentioning features", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause", 0.95, "nor the names of", r"neither the names? of .{1,120} nor the names of (?:its|their|the|any) contributors may be used to endorse or promote products"),
    ("bsd-3-clause", 0.9, "be used to endorse or promote products", r"the name of the authors? may not be used to endorse or promote products|neither the name of .{1,80} may be used to endorse or promote products"),
    ("bsd-3-clause-clear", 0.95, "", "no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-2-clause-patent", 0.95, "", "subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights under this license"),
    ("bsd", 0.9, "redistribution and use", r"redistribution and use (?:of this software )?in source and binary forms with or without modification are permitted"),
    ("bsd", 0.9, "", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 0.9, "", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", 0.8, "as is and any express or implied warranties", r"this software is provided by (?:the )?(?:copyright holders?|authors?|regents)(?: and contributors)? as is and any express or implied warranties"),
    # Apache
    ("apache-2", 0.95, "the license you may not use this file except in compliance with the license", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", 0.95, "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2", 0.9, "", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2", 0.9, "each contributor hereby grants to you", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license"),
    ("apache-1.1", 0.95, "", "this product includes software developed by the apache software foundation"),
    ("apache-1", 0.95, "", "this product includes software developed by the apache group"),
    ("llvm-exception", 0.95, "llvm", r"llvm exceptions? to the apache 2 0 license|with llvm exceptions?"),
    ("ecl-2", 0.95, "educational community", r"educational community licen[cs]e(?: version 2 0)?"),
    # The GNU licenses: notices, then sentences of their texts
    ("agpl-3", 0.95, "free software foundation", r"gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-3", 0.95, "free software foundation", r"gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", 0.95, "free software foundation", r"gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-2", 0.95, "free software foundation", r"gnu (?:library|lesser) general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-3", 0.95, "free software foundation", r"gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("gpl-2", 0.95, "free software foundation", r"gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-1", 0.95, "free software foundation", r"gnu general public license as published by the free software foundation (?:either )?version 1"),
    ("agpl", 0.9, "", "you should have received a copy of the gnu affero general public license"),
    ("lgpl", 0.9, "you should have received a copy of the gnu", r"you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("gpl", 0.9, "", "you should have received a copy of the gnu general public license"),
    ("gpl-3", 0.95, "", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2", 0.9, "", "the gnu general public license is intended to guarantee your freedom to share and change free software"),
    ("gpl-3", 0.9, "", "convey verbatim copies of the program s source code as you receive it"),
    ("gpl-2", 0.9, "", "you may copy and distribute verbatim copies of the program s source code as you receive it"),
    ("agpl-3", 0.95, "", "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation"),
    ("agpl-3", 0.9, "", "must prominently offer all users interacting with it remotely through a computer network"),
    ("lgpl-3", 0.95, "", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("lgpl-2.1", 0.95, "", "this is the first released version of the lesser gpl"),
    ("lgpl-2", 0.95, "", "this is the first released version of the library gpl"),
    ("gfdl", 0.95, "invariant sections", r"with no invariant sections (?:with )?no front cover texts and (?:with )?no back cover texts"),
    ("gfdl", 0.9, "", "the purpose of this license is to make a manual textbook or other functional and useful document free"),
    ("classpath-exception", 0.95, "classpath exception|independent modules", r"(?:with )?(?:the )?(?:gnu )?classpath exception(?: 2 0)?|give you permission to link this library with independent modules to produce an executable"),
    ("gcc-exception", 0.95, "runtime library exception|gcc exception", r"gcc runtime library exception(?: version 3 1)?|with gcc exception(?: [23] [01])?"),
    ("autoconf-exception", 0.95, "autoconf", r"configure script generated by autoconf .{0,80}same distribution terms|autoconf exception(?: [23] 0)?"),
    ("bison-exception", 0.95, "bison", r"bison exception(?: 2 2)?|part or all of the bison parser skeleton"),
    ("font-exception", 0.95, "font exception", r"font exception(?: 2 0)?"),
    ("linux-syscall-note", 0.95, "", "linux syscall note"),
    # Weak copyleft
    ("mpl-2", 0.95, "", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", 0.95, "", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", 0.95, "", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1", 0.95, "", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1.1", 0.95, "netscape public", r"netscape public licen[cs]e(?: version 1 [01])?"),
    ("epl-2", 0.95, "accompanying materials are made available under the terms of the eclipse", r"accompanying materials are made available under the terms of the eclipse public license (?:version |v )?2 0"),
    ("epl-1", 0.95, "accompanying materials are made available under the terms of the eclipse", r"accompanying materials are made available under the terms of the eclipse public license (?:version |v )?1 0"),
    ("edl-1", 0.95, "eclipse distribution", r"eclipse distribution licen[cs]e(?: (?:version |v )?1 0)?"),
    ("cddl-1", 0.95, "", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("ipl-1", 0.95, "ibm public", r"ibm public licen[cs]e(?: version 1 0)?"),
    ("cpal-1", 0.95, "common public attribution", r"common public attribution licen[cs]e(?: version 1 0)?"),
    ("ms-pl", 0.95, "microsoft public|ms pl", r"microsoft public licen[cs]e|ms pl"),
    ("ms-rl", 0.95, "microsoft reciprocal|ms rl", r"microsoft reciprocal licen[cs]e|ms rl"),
    ("apsl-2", 0.95, "apple public source", r"apple public source licen[cs]e(?: version 2 0)?"),
    ("osl-3", 0.95, "open software", r"open software licen[cs]e (?:version |v )?3 0"),
    ("afl-3", 0.95, "academic free", r"academic free licen[cs]e(?: (?:version |v )?3 0)?"),
    ("qpl-1", 0.95, "q public", r"q public licen[cs]e(?: version 1 0)?"),
    ("rpl-1.5", 0.95, "reciprocal public", r"reciprocal public licen[cs]e(?: (?:version )?1 5)?"),
    ("sissl", 0.95, "sun industry standards", r"sun industry standards source licen[cs]e"),
    ("spl-1", 0.95, "sun public", r"sun public licen[cs]e(?: version 1 0)?"),
    ("lppl-1.3c", 0.95, "latex project|lppl", r"latex project public licen[cs]e(?: version 1 3c?)?|lppl(?: (?:version )?1 3c?)?"),
    ("cecill-b", 0.95, "cecill b", r"cecill b(?: licen[cs]e)?"),
    ("cecill-c", 0.95, "cecill c", r"cecill c(?: licen[cs]e)?"),
    ("cecill", 0.9, "cecill", r"cecill(?: free software)?(?: licen[cs]e)?(?: agreement)?(?: 2 [01])?"),
    ("mulan-2", 0.95, "mulan", r"mulan psl (?:v|version )2|mulan permissive software licen[cs]e(?: (?:v|version )2)?"),
    # Short permissive ones and dedications
    ("unlicense", 0.95, "", "this is free and unencumbered software released into the public domain"),
    ("unlicense", 0.9, "", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc0-1", 0.95, "to the extent possible under law", r"to the extent possible under law .{1,120} waived all copyright and related or neighbou?ring rights"),
    ("cc0-1", 0.95, "", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("wtfpl", 0.95, "", "you just do what the fuck you want to"),
    ("zlib", 0.95, "", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", 0.95, "", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", 0.9, "", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("libpng", 0.95, "", "the png reference library is supplied as is"),
    ("ijg", 0.95, "", "this software is based in part on the work of the independent jpeg group"),
    ("freetype", 0.95, "freetype", r"freetype (?:project )?licen[cs]e|portions of this software are copyright .{1,30} the freetype project"),
    ("imagemagick", 0.95, "imagemagick", r"imagemagick licen[cs]e"),
    ("openssl", 0.95, "", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 0.95, "", "this product includes cryptographic software written by eric young"),
    ("python-2", 0.95, "", "psf is making python available to licensee on an as is basis"),
    ("cnri-python", 0.95, "cnri", r"cnri (?:open source )?(?:python )?licen[cs]e(?: agreement)?"),
    ("php-3", 0.95, "this product includes php", r"this product includes php(?: software)? freely available from"),
    ("beerware", 0.95, "beer", r"the beer ware licen[cs]e|you can buy me a beer in return"),
    ("vim", 0.95, "vim", r"vim licen[cs]e"),
    ("sleepycat", 0.95, "sleepycat", r"sleepycat licen[cs]e"),
    ("zpl-2.1", 0.95, "zope public|zpl", r"zope public licen[cs]e(?: zpl)?(?: version 2 [01])?|zpl 2 1"),
    ("w3c", 0.95, "w3c", r"w3c software (?:notice and |and document )(?:notice and )?licen[cs]e|w3c licen[cs]e"),
    ("nasa-1.3", 0.95, "nasa open source", r"nasa open source agreement(?: version 1 3)?"),
    ("openldap", 0.95, "openldap public", r"openldap public licen[cs]e(?: version 2 8)?"),
    ("upl-1", 0.95, "universal permissive", r"universal permissive licen[cs]e(?: (?:version |v )?1 0)?"),
    ("blueoak-1", 0.95, "blue oak", r"blue oak model licen[cs]e(?: 1 0 0)?"),
    ("lucent", 0.95, "lucent public", r"lucent public licen[cs]e(?: version 1 0[12]?)?"),
    ("intel", 0.95, "intel open source", r"intel open source licen[cs]e"),
    ("watcom-1", 0.95, "watcom public", r"(?:sybase )?open watcom public licen[cs]e(?: version 1 0)?"),
    ("realnetworks", 0.95, "realnetworks public", r"realnetworks public source licen[cs]e(?: version 1 0)?"),
    # Fonts, hardware, data
    ("ofl-1.1", 0.95, "", "this font software is licensed under the sil open font license"),
    ("ofl-1.1", 0.95, "", "the fonts and derivatives however cannot be released under any other type of license"),
    ("ubuntu-font", 0.95, "ubuntu font", r"ubuntu font licen[cs]e(?: (?:version )?1 0)?"),
    ("bitstream-vera", 0.95, "bitstream", r"bitstream vera (?:fonts? )?(?:copyright|licen[cs]e)|fonts are copyright bitstream inc"),
    ("cern-ohl", 0.95, "cern", r"cern open hardware licen[cs]e(?: (?:version |v )?[12](?: [012])?)?(?: (?:permissive|strongly reciprocal|weakly reciprocal))?|cern ohl"),
    ("tapr-ohl", 0.95, "tapr open hardware", r"tapr open hardware licen[cs]e"),
    ("solderpad", 0.95, "solderpad", r"solderpad hardware licen[cs]e(?: (?:version |v )?[02] [15]1?)?"),
    ("ogl", 0.95, "open government", r"open government licen[cs]e(?: (?:version |v)?[123](?: 0)?)?"),
    ("etalab-2", 0.95, "etalab", r"etalab (?:open )?licen[cs]e(?: 2 0)?|licence ouverte (?:open licence )?etalab"),
    ("dl-de", 0.95, "data license germany|data licence germany|datenlizenz deutschland", r"data licen[cs]e germany(?: attribution| zero)?|datenlizenz deutschland(?: namensnennung| zero)?"),
    ("cdla-permissive", 0.95, "community data license", r"community data license agreement permissive(?: (?:version )?[12] 0)?"),
    ("cdla-sharing", 0.95, "community data license", r"community data license agreement sharing(?: (?:version )?1 0)?"),
    ("odbl-1", 0.95, "made available under the open database license", r"database is made available under the open database license"),
    ("odbl-1", 0.9, "openstreetmap", r"openstreetmap contributors"),
    ("o-uda-1", 0.95, "", "open use of data agreement"),
    # Creative Commons deeds and legal code
    ("cc-by", 0.9, "", "you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-nc", 0.9, "", "you may not use the material for commercial purposes"),
    ("cc-sa", 0.9, "", "you must distribute your contributions under the same license as the original"),
    ("cc-nd", 0.9, "", "if you remix transform or build upon the material you may not distribute the modified material"),
    ("creative-commons", 0.9, "bound by the terms", r"you accept and agree to be bound by the terms (?:and conditions )?of this (?:creative commons|public license)"),
    ("creative-commons", 0.9, "some rights reserved", r"some rights reserved"),
    # Models
    ("llama-community", 0.95, "", "you are granted a non exclusive worldwide non transferable and royalty free limited license under meta s intellectual property"),
    ("gemma", 0.95, "", "gemma terms of use"),
    ("qwen", 0.95, "qwen|qianwen", r"qwen (?:research )?licen[cs]e(?: agreement)?|tongyi qianwen licen[cs]e(?: agreement)?"),
    ("deepseek", 0.95, "deepseek", r"deepseek (?:model )?licen[cs]e(?: agreement)?"),
    ("falcon", 0.95, "falcon", r"falcon (?:llm|180b|40b) (?:tii )?licen[cs]e"),
    ("stability-community", 0.95, "stability ai", r"stability ai (?:non commercial research )?(?:community )?licen[cs]e(?: agreement)?"),
    ("ai2-impact", 0.95, "ai2 impact", r"ai2 impact licen[cs]e(?: (?:low|medium|high) risk)?"),
    ("openrail", 0.9, "", "you agree not to use the model or derivatives of the model"),
    # Source available
    ("commons-clause", 0.95, "commons clause", r"commons clause(?: license condition)?(?: v1 0)?"),
    ("commons-clause", 0.95, "", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("polyform-noncommercial", 0.95, "polyform noncommercial", r"polyform noncommercial licen[cs]e(?: 1 0 0)?"),
    ("polyform-small-business", 0.95, "polyform small business", r"polyform small business licen[cs]e(?: 1 0 0)?"),
    ("polyform-shield", 0.95, "polyform shield", r"polyform shield licen[cs]e(?: 1 0 0)?"),
    ("polyform-strict", 0.95, "polyform strict", r"polyform strict licen[cs]e(?: 1 0 0)?"),
    ("prosperity", 0.95, "prosperity public", r"prosperity public licen[cs]e(?: 3 0 0)?"),
    ("parity", 0.95, "parity public", r"parity public licen[cs]e(?: 7 0 0)?"),
    ("hippocratic", 0.95, "hippocratic", r"hippocratic licen[cs]e(?: (?:version )?[123](?: [01])?)?"),
    ("confluent", 0.95, "confluent community", r"confluent community licen[cs]e(?: agreement)?(?: version 1 0)?"),
    ("rsal-2", 0.95, "redis source available|rsalv2", r"redis source available licen[cs]e(?: 2 0)?|rsalv2"),
    ("timescale", 0.95, "timescale", r"timescale licen[cs]e(?: agreement)?"),
    ("fsl-1.1", 0.95, "functional source|fsl 1 1", r"functional source licen[cs]e(?: version 1 1)?|fsl 1 1"),
    ("busl-1.1", 0.9, "change date", r"on the change date .{0,160}under the terms of the change license|effective on the change date"),
    ("elastic-2", 0.9, "", "you may not provide the software to third parties as a hosted or managed service"),
    ("sspl-1", 0.9, "", "if you make the functionality of the program or a modified version available to third parties as a service"),
    # Closed and restricted
    ("eula", 0.9, "end user", r"end user licen[cs]e agreement"),
    ("proprietary", 0.9, "", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", 0.9, "may be reproduced", r"no part of this (?:publication|book|document|work|website) may be reproduced"),
    ("proprietary", 0.9, "trade secret|trade secrets", r"contains (?:confidential|proprietary) information and trade secrets?|confidential and proprietary trade secrets?"),
    ("proprietary", 0.9, "licensed not sold", r"(?:the|this) software is licensed not sold"),
    ("noncommercial", 0.8, "use only", r"for (?:non ?commercial|academic|personal|educational|research)(?: and (?:non ?commercial|academic|personal|educational|research))? use only"),
    ("noncommercial", 0.8, "purposes only", r"for (?:non ?commercial|academic|educational|research) purposes only"),
    ("evaluation", 0.8, "evaluation", r"for evaluation (?:purposes|use) only|evaluation licen[cs]e agreement"),
    ("crown-copyright", 0.9, "", "crown copyright"),
    ("project-gutenberg", 0.95, "project gutenberg|this ebook is for the use", r"(?:full )?project gutenberg(?: tm)? licen[cs]e|this ebook is for the use of anyone anywhere"),
)

# Short forms, taken last: a better detection around one of them suppresses it.
NAMES = (
    ("agpl-3", 0.7, "agplv3|agpl3", r"agplv?3(?: 0)?"),
    ("agpl-1", 0.7, "agplv1|agpl1", r"agplv?1(?: 0)?"),
    ("lgpl-3", 0.7, "lgplv3|lgpl3", r"lgplv?3(?: 0)?"),
    ("lgpl-2.1", 0.7, "lgplv2 1|lgpl2 1|lgplv21|lgpl21", r"lgplv?2 ?1"),
    ("lgpl-2", 0.7, "lgplv2|lgpl2", r"lgplv?2(?: 0)?"),
    ("gpl-3", 0.7, "gplv3|gpl3", r"gplv?3(?: 0)?"),
    ("gpl-2", 0.7, "gplv2|gpl2", r"gplv?2(?: 0)?"),
    ("gpl-1", 0.7, "gplv1|gpl1", r"gplv?1(?: 0)?"),
    ("gfdl-1.3", 0.7, "gfdlv1 3|gfdl1 3", r"gfdlv?1 3"),
    ("gfdl-1.2", 0.7, "gfdlv1 2|gfdl1 2", r"gfdlv?1 2"),
    ("mpl-2", 0.7, "mplv2|mpl2", r"mplv?2(?: 0)?"),
    ("mpl-1.1", 0.7, "mplv1 1|mpl1 1", r"mplv?1 1"),
    ("epl-2", 0.7, "eplv2|epl2", r"eplv?2(?: 0)?"),
    ("epl-1", 0.7, "eplv1|epl1", r"eplv?1(?: 0)?"),
    ("eupl-1.2", 0.7, "euplv1 2|eupl1 2", r"euplv?1 2"),
    ("cddl-1", 0.7, "cddlv1|cddl1", r"cddlv?1(?: [01])?"),
    ("apache-2", 0.7, "apache2|apachev2|asl2|asl 2|aslv2", r"apachev?2(?: 0)?|asl ?2(?: 0)?|aslv2(?: 0)?"),
    ("bsd-3-clause", 0.7, "bsd3|bsd 3|bsd 3clause|bsd new", r"bsd3|bsd 3(?:clause)?|bsd new"),
    ("bsd-2-clause", 0.7, "bsd2|bsd 2|bsd 2clause", r"bsd2|bsd 2(?:clause)?"),
    ("mit", 0.7, "under mit|under the mit|under a mit", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the |a )?mit"),
    ("bsd", 0.7, "under bsd|under the bsd|under a bsd", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the |a )?bsd"),
    ("isc", 0.7, "under isc|under the isc", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?isc"),
    ("apache", 0.7, "under apache|under the apache", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?apache"),
    ("zlib", 0.7, "under zlib|under the zlib", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?zlib"),
    ("eupl", 0.7, "under eupl|under the eupl", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?eupl"),
    ("mpl", 0.7, "under mpl|under the mpl", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?mpl"),
    ("epl", 0.7, "under epl|under the epl", r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) under (?:the )?epl"),
    ("mit", 0.7, "license mit|licence mit|license is mit|licence is mit|mit licensed|mit licenced", r"licen[cs]e (?:is )?mit|mit licen[cs]ed"),
    ("bsd", 0.7, "license bsd|licence bsd|license is bsd|licence is bsd|bsd licensed|bsd licenced", r"licen[cs]e (?:is )?bsd|bsd licen[cs]ed"),
    ("isc", 0.7, "license isc|licence isc|isc licensed|isc licenced", r"licen[cs]e isc|isc licen[cs]ed"),
    ("apache", 0.7, "license apache|licence apache|apache licensed|apache licenced", r"licen[cs]e apache|apache licen[cs]ed"),
    ("zlib", 0.7, "license zlib|licence zlib|zlib licensed|zlib licenced", r"licen[cs]e zlib|zlib licen[cs]ed"),
    ("mpl", 0.7, "license mpl|licence mpl|mpl licensed|mpl licenced", r"licen[cs]e mpl|mpl licen[cs]ed"),
    ("epl", 0.7, "license epl|licence epl|epl licensed|epl licenced", r"licen[cs]e epl|epl licen[cs]ed"),
    ("unlicense", 0.7, "", "the unlicence"),
    ("copyleft", 0.6, "copyleft", r"copyleft licen[cs]e"),
)
