"""Licenses by their own wording: hand-written expressions for bodies, notices and headers, without the name.

Each is (label, confidence, keywords, expression) over the normalised words, in order of priority: whole
bodies that tell variants of a family apart come before the sentences that the family shares, so a sentence
inside an interval already taken says nothing. All keywords must occur for an expression to be tried; the
first is searched in every text.
"""

# Label, confidence, keywords (first: the gate), expression on words joined by one space.
SIGNATURES = [
    # ---- permissive bodies whose variants differ further down
    ("mit-0", 0.95, ("permission is hereby granted free of charge", "furnished to do so the software is provided"),
     r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files .{0,400}?furnished to do so the software is provided as is"),
    ("x11", 0.95, ("permission is hereby granted free of charge", "except as contained in this notice"),
     r"permission is hereby granted free of charge to any person obtaining a copy .{0,1800}?except as contained in this notice the names? of .{1,200}?shall not be used in advertising"),
    ("ncsa", 0.95, ("permission is hereby granted free of charge", "to deal with the software without restriction"),
     r"permission is hereby granted free of charge to any person obtaining a copy .{0,200}?to deal with the software without restriction"),
    ("json", 0.95, ("permission is hereby granted free of charge", "shall be used for good not evil"),
     r"permission is hereby granted free of charge to any person obtaining a copy .{0,900}?the software shall be used for good not evil"),
    ("curl", 0.95, ("permission to use copy modify and distribute this software", "and this permission notice appear in all copies"),
     r"permission to use copy modify and distribute this software (?:and its documentation )?for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty of any kind express or implied including but not limited to"),
    ("bsl-1", 0.95, ("permission is hereby granted free of charge", "person or organization obtaining a copy"),
     r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1", 0.9, ("machine executable object code", "source language processor"),
     r"(?:solely )?in the form of machine executable object code generated by a source language processor"),
    ("ofl", 0.95, ("permission is hereby granted free of charge", "copy of the font software"),
     r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("unicode", 0.95, ("permission is hereby granted free of charge", "unicode data files"),
     r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("mit", 0.95, ("permission is hereby granted free of charge",),
     r"permission is hereby granted free of charge to any person obtaining a copy of (?:this|the) software(?: and associated documentation files)?"),
    ("mit", 0.9, ("permission is hereby granted free of charge",), r"permission is hereby granted free of charge to any person"),
    ("mit", 0.85, ("to deal in the software without restriction",), r"to deal in the software without restriction"),
    ("mit", 0.8, ("shall be included in all copies or substantial portions of the software",),
     r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 0.75, ("use copy modify merge publish distribute sublicense",), r"rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 0.75, ("authors or copyright holders be liable",),
     r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    # ---- BSD family
    ("bsd-4-clause", 0.95, ("redistribution and use in source and binary forms", "all advertising materials mentioning features"),
     r"redistribution and use in source and binary forms with or without modification .{0,1500}?all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause-clear", 0.95, ("redistribution and use in source and binary forms", "no express or implied licenses to any party s patent rights"),
     r"redistribution and use in source and binary forms with or without modification .{0,2500}?no express or implied licenses to any party s patent rights are granted"),
    ("apache-1.1", 0.95, ("redistribution and use in source and binary forms", "software developed by the apache software foundation"),
     r"redistribution and use in source and binary forms with or without modification .{0,1800}?this product includes software developed by the apache software foundation"),
    ("openssl", 0.95, ("redistribution and use in source and binary forms", "for use in the openssl toolkit"),
     r"redistribution and use in source and binary forms with or without modification .{0,1800}?for use in the openssl toolkit"),
    ("bsd-3-clause", 0.95, ("redistribution and use in source and binary forms", "neither the name"),
     r"redistribution and use in source and binary forms with or without modification .{0,1800}?neither the names? of .{1,200}?(?:may|can) be used to endorse or promote products"),
    ("bsd-3-clause", 0.95, ("redistribution and use in source and binary forms", "may not be used to endorse or promote products"),
     r"redistribution and use in source and binary forms with or without modification .{0,1800}?may not be used to endorse or promote products derived from this software"),
    ("bsd-2-clause", 0.95, ("redistribution and use in source and binary forms", "redistributions in binary form must reproduce"),
     r"redistribution and use in source and binary forms with or without modification .{0,700}?redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-1-clause", 0.9, ("redistribution and use in source and binary forms", "redistributions of source code must retain"),
     r"redistribution and use in source and binary forms with or without modification .{0,200}?redistributions of source code must retain the above copyright notice"),
    ("bsd", 0.85, ("redistribution and use in source and binary forms",), r"redistribution and use in source and binary forms(?: with or without modification)?"),
    ("bsd", 0.75, ("redistributions of source code must retain",), r"redistributions of source code must retain the (?:above )?copyright notices?"),
    ("bsd", 0.75, ("redistributions in binary form must reproduce",), r"redistributions in binary form must reproduce the (?:above )?copyright notices?"),
    ("bsd-3-clause", 0.8, ("nor the names of its contributors",), r"neither the names? of .{1,200}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", 0.75, ("copyright holders and contributors as is",), r"this software is provided by the (?:copyright holders and contributors|regents and contributors|authors?) as is and any express or implied warranties"),
    ("bsd", 0.85, ("bsd style",), r"(?:use of this source code is )?governed by a bsd style licen[cs]e(?: that can be found in the licen[cs]e file)?"),
    ("mit", 0.85, ("mit style",), r"(?:use of this source code is )?governed by an mit style licen[cs]e(?: that can be found in the licen[cs]e file)?"),
    ("openssl", 0.9, ("this product includes software developed by the openssl project",), r"this product includes software developed by the openssl project"),
    ("ssleay", 0.9, ("cryptographic software written by eric young",), r"this product includes cryptographic software written by eric young"),
    ("apache-1.1", 0.85, ("software developed by the apache software foundation",), r"this product includes software developed by the apache software foundation"),
    # ---- ISC and older permission notices
    ("0bsd", 0.95, ("permission to use copy modify and or distribute this software", "is hereby granted the software is provided"),
     r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", 0.95, ("permission to use copy modify and or distribute this software",), r"permission to use copy modify and or distribute this software"),
    ("isc", 0.95, ("permission to use copy modify and distribute this software", "and the author disclaims all warranties"),
     r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted .{0,200}?the software is provided as is and (?:the author|isc|internet systems consortium) disclaims all warranties"),
    ("isc", 0.85, ("author disclaims all warranties with regard to this software",), r"(?:the )?author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("postgresql", 0.95, ("permission to use copy modify and distribute this software", "without a written agreement"),
     r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ntp", 0.9, ("permission to use copy modify and distribute this software", "makes no representations about the suitability"),
     r"permission to use copy modify and distribute this software and its documentation for any purpose .{0,700}?makes no representations about the suitability (?:of )?this software for any purpose"),
    ("hpnd", 0.85, ("permission to use copy modify and distribute this software", "supporting documentation"),
     r"permission to use copy modify and distribute this software and its documentation .{0,300}?appear in supporting documentation"),
    ("isc", 0.8, ("permission to use copy modify and distribute this software",), r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("x11", 0.85, ("permission to use copy modify distribute and sell this software",), r"permission to use copy modify distribute and sell this software and its documentation for any purpose"),
    ("fsfap", 0.9, ("copying and distribution of this file with or without modification",), r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("fsful", 0.9, ("gives unlimited permission to copy",), r"gives unlimited permission to copy and or distribute it"),
    ("w3c", 0.9, ("permission to copy modify and distribute this software",), r"permission to copy modify and distribute this software and its documentation with or without modification for any purpose and without fee or royalty"),
    ("bsd-source-code", 0.8, ("redistribution and use of this software and associated documentation",), r"redistribution and use of this software and associated documentation software with or without modification are permitted"),
    # ---- zlib, public domain and the like
    ("zlib", 0.95, ("permission is granted to anyone to use this software",), r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib", 0.9, ("the origin of this software must not be misrepresented",), r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 0.85, ("altered source versions must be plainly marked",), r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", 0.8, ("held liable for any damages arising from the use of this software",), r"in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("unlicense", 0.95, ("free and unencumbered software released into the public domain",), r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 0.85, ("dedicate any and all copyright interest in the software",), r"dedicate any and all copyright interest in the software to the public domain"),
    ("unlicense", 0.8, ("anyone is free to copy modify publish use compile",), r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 0.95, ("you just do what the fuck you want to",), r"you just do what the fuck you want to"),
    ("beerware", 0.95, ("you can buy me a beer",), r"(?:if we meet some day and you think this stuff is worth it )?you can buy me a beer in return"),
    ("sqlite-blessing", 0.95, ("may you do good and not evil",), r"may you do good and not evil"),
    ("sqlite-blessing", 0.85, ("the author disclaims copyright to this source code",), r"the author disclaims copyright to this source code"),
    ("cc0", 0.95, ("the person who associated a work with this deed",), r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", 0.95, ("overtly fully permanently irrevocably and unconditionally waives",), r"overtly fully permanently irrevocably and unconditionally waives abandons and surrenders"),
    ("public-domain", 0.8, ("into the public domain",), r"(?:hereby )?(?:place[sd]?|put|released?|donated?|dedicated?) (?:it |this (?:code|file|software|work) |is |are )?into the public domain"),
    ("public-domain", 0.8, ("is in the public domain",), r"this (?:code|file|software|work|program|document) is in the public domain"),
    ("pddl", 0.9, ("dedicates the work to the public domain",), r"(?:the rightsholder )?(?:permanently and irrevocably )?dedicates the work to the public domain"),
    # ---- Apache, Mozilla, Eclipse, Sun
    ("apache-2", 0.95, ("except in compliance with the license", "apache org licenses license 2 0"),
     r"you may not use this file except in compliance with the license .{0,120}?apache org licenses license 2 0"),
    ("apache-2", 0.9, ("apache org licenses license 2 0",), r"(?:https? )?(?:www )?apache org licenses license 2 0"),
    ("apache-2", 0.9, ("to you a perpetual worldwide non exclusive no charge royalty free irrevocable",),
     r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated)"),
    ("apache-2", 0.85, ("terms and conditions for use reproduction and distribution",), r"terms and conditions for use reproduction and distribution"),
    ("apache-2", 0.8, ("distributed on an as is basis without warranties or conditions of any kind",), r"distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2", 0.85, ("licensed to the apache software foundation",), r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    ("mpl-2", 0.95, ("mozilla org mpl 2 0",), r"(?:https? )?(?:www )?mozilla org mpl 2 0"),
    ("mpl-2", 0.95, ("this source code form is subject to the terms of",), r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0"),
    ("mpl-2", 0.85, ("incompatible with secondary licenses",), r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", 0.9, ("the contents of this file are subject to the mozilla public license",), r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-1.1", 0.9, ("mozilla org mpl mpl 1 1",), r"(?:https? )?(?:www )?mozilla org mpl mpl 1 1"),
    ("cddl", 0.9, ("the contents of this file are subject to the terms of the common development",), r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("epl-2", 0.95, ("eclipse org legal epl 2 0",), r"(?:https? )?(?:www )?eclipse org legal epl 2 0"),
    ("epl-1", 0.95, ("eclipse org legal epl v10",), r"(?:https? )?(?:www )?eclipse org legal epl v10"),
    ("epl-2", 0.9, ("accompanying program is provided under the terms of this eclipse public license",), r"the accompanying program is provided under the terms of this eclipse public licen[cs]e"),
    ("cpl", 0.9, ("accompanying program is provided under the terms of this common public license",), r"the accompanying program is provided under the terms of this common public licen[cs]e"),
    # ---- GNU notices and bodies
    ("agpl-3", 0.95, ("affero general public license as published by", "version 3"), r"(?:gnu )?affero general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    ("lgpl-3", 0.95, ("lesser general public license as published by", "version 3"), r"(?:gnu )?lesser general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    ("lgpl-2.1", 0.95, ("lesser general public license as published by", "version 2 1"), r"(?:gnu )?lesser general public licen[cs]e as published by the free software foundation(?: either)? version 2 1"),
    ("lgpl", 0.95, ("library general public license as published by",), r"(?:gnu )?library general public licen[cs]e as published by the free software foundation(?: either)?(?: version 2)?"),
    ("gpl-3", 0.95, ("gnu general public license as published by", "version 3"), r"gnu general public licen[cs]e as published by the free software foundation(?: either)? version 3"),
    ("gpl-2", 0.95, ("gnu general public license as published by", "version 2"), r"gnu general public licen[cs]e as published by the free software foundation(?: either)? version 2"),
    ("gpl", 0.85, ("this program is free software you can redistribute it",), r"this program is free software you can redistribute it and or modify it"),
    ("lgpl", 0.85, ("this library is free software you can redistribute it",), r"this library is free software you can redistribute it and or modify it"),
    ("agpl-3", 0.9, ("interacting with it remotely through a computer network",), r"all users interacting with it remotely through a computer network"),
    ("gpl-3", 0.9, ("to take away your freedom to share and change the works",), r"licen[cs]es for most software and other practical works are designed to take away your freedom to share and change the works"),
    ("gpl-2", 0.9, ("to take away your freedom to share and change it",), r"licen[cs]es for most software are designed to take away your freedom to share and change it"),
    ("gpl", 0.8, ("should have received a copy of the gnu general public license",), r"you should have received a copy of the gnu general public licen[cs]e along with this (?:program|software|file)"),
    ("lgpl", 0.8, ("should have received a copy of the gnu lesser general public license",), r"you should have received a copy of the gnu lesser general public licen[cs]e along with this (?:library|program|software)"),
    ("agpl", 0.8, ("should have received a copy of the gnu affero general public license",), r"you should have received a copy of the gnu affero general public licen[cs]e"),
    ("lgpl", 0.85, ("work that uses the library",), r"a work that uses the library in isolation is not a derivative work"),
    ("gfdl", 0.95, ("permission is granted to copy distribute and or modify this document",), r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("gfdl", 0.85, ("no invariant sections",), r"with no invariant sections(?: no front cover texts and no back cover texts)?"),
    ("gcc-exception", 0.85, ("as a special exception", "link"), r"as a special exception .{0,200}?permission to link"),
    # ---- Creative Commons and data
    ("cc-by-nc-sa", 0.95, ("creativecommons org licenses by nc sa",), r"creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", 0.95, ("creativecommons org licenses by nc nd",), r"creativecommons org licenses by nc nd"),
    ("cc-by-nc", 0.95, ("creativecommons org licenses by nc",), r"creativecommons org licenses by nc"),
    ("cc-by-nd", 0.95, ("creativecommons org licenses by nd",), r"creativecommons org licenses by nd"),
    ("cc-by-sa", 0.95, ("creativecommons org licenses by sa",), r"creativecommons org licenses by sa"),
    ("cc-by", 0.95, ("creativecommons org licenses by",), r"creativecommons org licenses by"),
    ("cc0", 0.95, ("creativecommons org publicdomain zero",), r"creativecommons org publicdomain zero(?: 1 0)?"),
    ("odbl", 0.95, ("opendatacommons org licenses odbl",), r"opendatacommons org licenses odbl"),
    ("pddl", 0.95, ("opendatacommons org licenses pddl",), r"opendatacommons org licenses pddl"),
    # ---- others
    ("ofl", 0.9, ("font software may be bundled redistributed",), r"(?:original or modified versions of the )?font software may be bundled redistributed and or sold with any software"),
    ("ofl", 0.85, ("reserved font name",), r"no modified version of the font software may use the reserved font names?"),
    ("artistic-2", 0.9, ("you are permitted to use the standard version",), r"you are permitted to use the standard version and create and use modified versions"),
    ("artistic-1", 0.9, ("semblance of artistic control",), r"maintains some semblance of artistic control over the development of the package"),
    ("python-2", 0.95, ("psf is making python available to licensee",), r"psf is making python available to licensee on an as is basis"),
    ("ms-pl", 0.9, ("if you bring a patent claim against any contributor",), r"if you bring a patent claim against any contributor over patents that you claim are infringed by the software"),
    ("sspl", 0.95, ("functionality of the program or a modified version available to third parties as a service",), r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", 0.9, ("make non production use of the licensed work",), r"(?:the right to )?copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("elastic-2", 0.9, ("hosted or managed service", "substantial set of the features"), r"provide the software to third parties as a hosted or managed service .{0,120}?substantial set of the features"),
    ("osl-3", 0.85, ("open software license version 3 0",), r"licensed under the open software licen[cs]e version 3 0"),
    ("eupl", 0.85, ("licensed under the eupl",), r"licensed under the eupl"),
    ("ijg", 0.9, ("this software is based in part on the work of the independent jpeg group",), r"this software is based in part on the work of the independent jpeg group"),
    ("libpng", 0.85, ("contributing authors and group 42",), r"the contributing authors and group 42 inc disclaim all warranties"),
    ("proprietary", 0.8, ("unauthorized copying of this file",), r"unauthorized copying of this file via any medium is strictly prohibited"),
]
