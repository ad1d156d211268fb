"""Signatures of license texts and notices, written by hand: label, pattern over lower-case words.

The first word is plain, since rules are gated by it.  Phrases are those of the published
licenses (fixed values), word by word as ``licenses.words`` reads a text.
"""

NOTICES = [
    # MIT and its relatives
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", r"to deal in the software without restriction including without limitation the rights"),
    ("mit", r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", r"except as contained in this notice the names? of (?:\w+ ){1,6}shall not be used in advertising"),
    ("ncsa", r"university of illinois(?: at urbana champaign)?(?: ncsa)? open source licen[cs]e"),
    ("ncsa", r"deal with the software without restriction including without limitation the rights"),
    ("icu", r"provided that the above copyright notices? and this permission notice appear in all copies of the software"),
    ("unicode", r"unicode licen[cs]e agreement data files and software"),
    ("unicode", r"unicode data files and any associated documentation"),
    ("json", r"the software shall be used for good not evil"),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided"),
    ("hpnd", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("hpnd", r"makes no representations about the suitability of this software for any purpose"),
    ("hpnd-sell-variant", r"permission to use copy modify distribute and sell this software and its documentation"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose"),
    ("isc", r"the author disclaims all warranties with regard to this software including all implied warranties"),
    ("isc", r"the software is provided as is and (?:the author|\w+) disclaims all warranties with regard to this software"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("ntp", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("tcl", r"the authors hereby grant permission to use copy modify distribute and licen[cs]e this software"),
    # BSD
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", r"this software is provided by the (?:copyright holders?|regents|authors?)(?: and contributors)? as is and any express or implied warranties"),
    ("bsd-3-clause", r"neither the name of (?:\w+ ){1,6}nor the names of its contributors"),
    ("bsd-3-clause", r"may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-4-clause", r"this product includes software developed by the university of california"),
    ("bsd-2-clause-views", r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd-3-clause-clear", r"no express or implied licen[cs]es to any party s patent rights are granted"),
    ("bsd-3-clause-no-nuclear", r"not designed licensed or intended for use in the design construction operation or maintenance of any nuclear facility"),
    ("bsd-2-clause-patent", r"subject to the terms and conditions of this licen[cs]e each copyright holder and contributor hereby grants"),
    ("bsd", r"use of this source code is governed by a bsd style licen[cs]e"),
    ("mit", r"use of this source code is governed by an mit style licen[cs]e"),
    # Apache
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", r"you may obtain a copy of the licen[cs]e at https? www apache org licenses license 2 0"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e"),
    ("apache-2.0", r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    ("apache-2.0", r"grant of patent licen[cs]e subject to the terms and conditions of this licen[cs]e"),
    ("apache-2.0", r"apache org licenses license 2 0"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("apache-1.0", r"this product includes software developed by the apache group for use in the apache http server project"),
    # GNU
    ("gpl", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", r"this program is distributed in the hope that it will be useful"),
    ("gpl", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("gpl", r"this is free software and you are welcome to redistribute it under certain conditions"),
    ("gpl", r"comes with absolutely no warranty for details type show w"),
    ("gpl", r"the licenses for most software are designed to take away your freedom"),
    ("gpl", r"gnu general public licen[cs]e as published by the free software foundation"),
    ("gpl-1.0-or-later", r"either version 1 (?:of the licen[cs]e )?or at your option any later version"),
    ("gpl-2.0-or-later", r"either version 2 (?:of the licen[cs]e )?or at your option any later version"),
    ("gpl-3.0-or-later", r"either version 3 (?:of the licen[cs]e )?or at your option any later version"),
    ("gpl-2.0", r"gnu general public licen[cs]e as published by the free software foundation version 2"),
    ("gpl-3.0", r"gnu general public licen[cs]e as published by the free software foundation version 3"),
    ("gpl-3.0", r"the gnu general public licen[cs]e is a free copyleft licen[cs]e for software and other kinds of works"),
    ("gpl-2.0", r"59 temple place suite 330 boston ma 02111 1307"),
    ("gpl-2.0", r"51 franklin st(?:reet)? fifth floor boston ma 02110 1301"),
    ("gpl-1.0", r"675 mass ave cambridge ma 02139"),
    ("gcc-exception-3.1", r"gcc runtime library exception(?: version 3 1)?"),
    ("classpath-exception-2.0", r"linking this library statically or dynamically with other modules is making a combined work"),
    ("classpath-exception-2.0", r"classpath exception"),
    ("font-exception-2.0", r"as a special exception if you create a document which uses this font"),
    ("bison-exception-2.2", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("autoconf-exception-3.0", r"as a special exception (?:to the gnu general public licen[cs]e )?if you distribute this file as part of a program that contains a configuration script"),
    ("openssl-exception", r"permission to link the code of portions of this program with the openssl library"),
    ("linking-exception", r"as a special exception the copyright holders of this library give you permission to link"),
    ("linux-syscall-note", r"this copyright does not cover user programs that use kernel services by normal system calls"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it"),
    ("lgpl", r"this library is distributed in the hope that it will be useful"),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e"),
    ("lgpl-2.1-or-later", r"either version 2 1 (?:of the licen[cs]e )?or at your option any later version"),
    ("lgpl-2.1", r"this licen[cs]e the lesser general public licen[cs]e applies to some specially designated software"),
    ("lgpl-3.0", r"this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3"),
    ("agpl-3.0", r"the gnu affero general public licen[cs]e is a free copyleft licen[cs]e"),
    ("agpl-3.0", r"all users interacting with it remotely through a computer network"),
    ("agpl", r"you should have received a copy of the gnu affero general public licen[cs]e"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("gfdl", r"with no invariant sections no front cover texts and no back cover texts"),
    ("fsfap", r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("fsfullr", r"this file is free software the free software foundation gives unlimited permission to copy and or distribute it"),
    # Mozilla, Eclipse, Sun, IBM
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file"),
    ("mpl-2.0", r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-1.0", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 0"),
    ("npl-1.1", r"the contents of this file are subject to the netscape public licen[cs]e"),
    ("mpl-1.1", r"alternatively the contents of this file may be used under the terms of either the gnu general public licen[cs]e"),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?1 0"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v?(?:ersion)? ?2 0"),
    ("epl-1.0", r"the accompanying program is provided under the terms of this eclipse public licen[cs]e"),
    ("cpl-1.0", r"the accompanying program is provided under the terms of this common public licen[cs]e"),
    ("ipl-1.0", r"the accompanying program is provided under the terms of this ibm public licen[cs]e"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("cddl", r"you can obtain a copy of the licen[cs]e at usr src opensolaris licen[cs]e"),
    ("sissl", r"sun industry standards source licen[cs]e"),
    ("apsl-2.0", r"apple public source licen[cs]e"),
    ("apsl-2.0", r"this file contains original code and or modifications of original code as defined in"),
    ("qpl-1.0", r"q public licen[cs]e(?: version 1 0)?"),
    ("lpl-1.02", r"lucent public licen[cs]e"),
    ("cpal-1.0", r"common public attribution licen[cs]e"),
    ("eupl", r"licensed under the eupl"),
    ("cecill", r"governed by the cecill(?: b| c)? licen[cs]e"),
    ("mulan-psl-2.0", r"mulan psl v2"),
    ("ms-pl", r"microsoft public licen[cs]e ms pl"),
    ("ms-lpl", r"microsoft limited public licen[cs]e"),
    # Creative Commons and open content
    ("cc", r"creativecommons org licenses by(?: nc| nd| sa){0,2}"),
    ("cc-by-4.0", r"creativecommons org licenses by 4 0"),
    ("cc-by-3.0", r"creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", r"creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", r"creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nd-4.0", r"creativecommons org licenses by nd 4 0"),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0"),
    ("cc-pdm-1.0", r"creativecommons org publicdomain mark 1 0"),
    ("cc0-1.0", r"to the extent possible under law (?:\w+ ){1,8}has waived all copyright and related or neighboring rights"),
    ("cc-by-sa", r"text is available under the creative commons attribution share ?alike licen[cs]e"),
    ("cc", r"by exercising the licensed rights defined below you accept and agree to be bound"),
    ("cc", r"some rights reserved"),
    ("opl-1.0", r"open publication licen[cs]e"),
    ("free-art-1.3", r"free art licen[cs]e(?: 1 3)?"),
    # Data and models
    ("odbl-1.0", r"made available under the open database licen[cs]e"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", r"open data commons public domain dedication (?:and )?licen[cs]e"),
    ("cdla-permissive", r"community data licen[cs]e agreement permissive"),
    ("cdla-sharing", r"community data licen[cs]e agreement sharing"),
    ("ogl-uk-3.0", r"open government licen[cs]e(?: v?3 0)?"),
    ("etalab-2.0", r"licence ouverte(?: open licen[cs]e)?"),
    ("openrail", r"creativeml open rail(?: \w)? licen[cs]e"),
    ("openrail", r"responsible ai licen[cs]e"),
    ("llama-community", r"llama 2 community licen[cs]e agreement"),
    # Short permissive licenses and dedications
    ("zlib", r"altered source versions must be plainly marked as such"),
    ("zlib", r"this notice may not be removed or altered from any source distribution"),
    ("zlib", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("libpng", r"the origin of this source code must not be misrepresented"),
    ("ijg", r"this software is based in part on the work of the independent jpeg group"),
    ("bsl-1.0", r"distributed under the boost software licen[cs]e"),
    ("bsl-1.0", r"boost org license 1 0 txt"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", r"unlicense org"),
    ("wtfpl", r"you just do what the fuck you want to"),
    ("beerware", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("blessing", r"may you do good and not evil"),
    ("blessing", r"the author disclaims copyright to this source code"),
    ("public-domain", r"released into the public domain"),
    ("public-domain", r"dedicated to the public domain"),
    ("public-domain", r"placed in the public domain"),
    ("public-domain", r"this file is in the public domain"),
    ("public-domain", r"this work is in the public domain"),
    ("public-domain", r"this code is in the public domain"),
    ("public-domain", r"this software is in the public domain"),
    ("public-domain", r"no copyright is claimed"),
    ("us-government-work", r"not subject to copyright protection (?:and is )?in the public domain"),
    # Languages and projects
    ("artistic-perl", r"you can redistribute it and or modify it under the same terms as perl itself"),
    ("artistic", r"under the terms of (?:either )?the artistic licen[cs]e"),
    ("psf-2.0", r"psf licen[cs]e agreement for python"),
    ("psf-2.0", r"python software foundation all rights reserved"),
    ("cnri-python", r"cnri open source licen[cs]e agreement"),
    ("php-3.01", r"this source file is subject to version 3 01 of the php licen[cs]e"),
    ("ruby", r"you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("openssl", r"this product includes software developed by the openssl project"),
    ("ssleay", r"this product includes cryptographic software written by eric young"),
    ("ofl-1.1", r"this font software is licensed under the sil open font licen[cs]e"),
    ("ofl-1.1", r"with reserved font name"),
    ("w3c", r"by obtaining using and or copying this work you the licensee agree"),
    ("vim", r"there are no restrictions on distributing unmodified copies of vim"),
    # Source-available and closed
    ("commons-clause", r"commons clause licen[cs]e condition"),
    ("sspl-1.0", r"offering the program as a service"),
    ("busl-1.1", r"use of this software is governed by the business source licen[cs]e"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service"),
    ("polyform-noncommercial", r"polyform noncommercial licen[cs]e"),
    ("polyform", r"polyform (?:shield|strict|perimeter|small business) licen[cs]e"),
    ("non-commercial", r"for non commercial (?:use|purposes) only"),
    ("non-commercial", r"for noncommercial (?:use|purposes) only"),
    ("non-commercial", r"free for non commercial use"),
    ("non-commercial", r"free for noncommercial use"),
    ("research-only", r"for research purposes only"),
    ("proprietary", r"all rights reserved"),
    ("proprietary", r"confidential and proprietary"),
    ("proprietary", r"unauthorized (?:copying|reproduction|distribution) of this file via any medium is strictly prohibited"),
    ("proprietary", r"no part of this publication may be reproduced"),
    ("proprietary", r"end user licen[cs]e agreement"),
    ("proprietary", r"trade secrets of (?:\w+ ){1,6}and may not be"),
]
