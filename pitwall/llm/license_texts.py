"""License names with the headers, file openings, notices and SPDX lines that stand for them."""

from __future__ import annotations

# Names, dates and wordings as the licenses state them.
_GNU = (
    ("GPL-1.0", "GNU General Public License", "1", "February 1989"), ("GPL-2.0", "GNU General Public License", "2", "June 1991"), ("GPL-3.0", "GNU General Public License", "3", "29 June 2007"),
    ("LGPL-2.0", "GNU Library General Public License", "2", "June 1991"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999"), ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007"), ("GFDL-1.2", "GNU Free Documentation License", "1.2", "November 2002"), ("GFDL-1.3", "GNU Free Documentation License", "1.3", "3 November 2008"),
)
#: Without a version any one published holds.
_GNU_ANY = (("GPL-1.0-or-later", "GNU General Public License"), ("LGPL-2.0-or-later", "GNU Lesser General Public License"), ("AGPL-1.0-or-later", "GNU Affero General Public License"), ("GFDL-1.1-or-later", "GNU Free Documentation License"))
_PLAIN = ("Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This project is licensed under the {}.", "This library is licensed under the {}.", "This program is free software; you can redistribute it under the terms of the {}.")
_GNU_HEADERS = (
    "This {} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.",
    "This {} is free software; you can redistribute it and/or modify it under the terms of the {} version {} as published by the Free Software Foundation.",
)
_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"), ("BY-ND", "Attribution-NoDerivs"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs"))
_CC_VERSIONS = (("-4.0", "4.0 International"), ("-3.0", "3.0 Unported"), ("-2.5", "2.5 Generic"), ("-2.0", "2.0 Generic"), ("-1.0", "1.0 Generic"), ("", ""))
_CC_FORMS = (
    "This work is licensed under a Creative Commons {name} {version} License.", "Licensed under a Creative Commons {name} {version} License.", "Creative Commons {name} {version} Public License", "Creative Commons {name} {version}",
    "Licensed under CC {code} {number}.", "This work is licensed under CC {code} {number}.",
    "This work is licensed under the Creative Commons {name} {version} License. To view a copy of this license, visit https://creativecommons.org/licenses/{code}/{number}/",
)
#: "The MIT License (MIT)" is at least 0.94 like "The MIT License" whatever the weights; as a template it would need "mit", a common German word.
#: Licenses with a name and a version or none: notices and, as they are, titles of their files.
_NAMED = (
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-1.1", "Apache Software License, Version 1.1"), ("MIT", "MIT License"), ("MIT", "The MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "Simplified BSD License"), ("BSD-2-Clause", "BSD 2-Clause \"Simplified\" License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "New BSD License"), ("BSD-3-Clause", "BSD 3-Clause \"New\" or \"Revised\" License"),
    ("BSD-4-Clause", "BSD 4-Clause License"), ("0BSD", "BSD Zero Clause License"), ("MPL-1.1", "Mozilla Public License Version 1.1"), ("MPL-2.0", "Mozilla Public License Version 2.0"), ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-1.0", "Eclipse Public License, Version 1.0"), ("EPL-2.0", "Eclipse Public License, Version 2.0"), ("EUPL-1.1", "European Union Public Licence, Version 1.1"), ("EUPL-1.2", "European Union Public Licence, Version 1.2"),
    ("ECL-2.0", "Educational Community License, Version 2.0"), ("AFL-3.0", "Academic Free License, Version 3.0"), ("OSL-3.0", "Open Software License, Version 3.0"), ("BSL-1.0", "Boost Software License, Version 1.0"), ("Artistic-2.0", "Artistic License 2.0"),
    ("CDDL-1.0", "Common Development and Distribution License, Version 1.0"), ("CDDL-1.1", "Common Development and Distribution License, Version 1.1"), ("OFL-1.1", "SIL Open Font License, Version 1.1"), ("UPL-1.0", "Universal Permissive License, Version 1.0"),
    ("Zlib", "zlib License"), ("PostgreSQL", "PostgreSQL License"), ("MS-PL", "Microsoft Public License"), ("MS-RL", "Microsoft Reciprocal License"), ("CC0-1.0", "CC0 1.0 Universal"), ("Unlicense", "Unlicense"),
)
_REDISTRIBUTE = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_CLAUSES = (" 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
            " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_NEITHER = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_APACHE = "Licensed under the {}, Version {} (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
_WARRANTY = ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
             " See the License for the specific language governing permissions and limitations under the License.")
_FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights"
          " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
_TEXTS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004"), ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"), ("Apache-2.0", _APACHE.format("Apache License", "2.0")),
    ("Apache-2.0", _APACHE.format("Apache License", "2.0") + " http://www.apache.org/licenses/LICENSE-2.0 " + _WARRANTY), ("ECL-2.0", _APACHE.format("Educational Community License", "2.0")),
    ("MIT", _GRANT), ("MIT", _GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", _FEE + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", _REDISTRIBUTE + _CLAUSES + _NEITHER), ("BSD-2-Clause", _REDISTRIBUTE + _CLAUSES), ("BSD-3-Clause", _NEITHER.strip()),
    ("BSD-4-Clause", "3. All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"), ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"), ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE Version 2, December 2004"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"), ("CC0-1.0", "Licensed under CC0 1.0."), ("OFL-1.1", "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."), ("Apache-2.0", "This project is licensed under the Apache License 2.0 - see the LICENSE file for details."),
)


def _all() -> list[tuple[str, str]]:
    out = [*_TEXTS]
    for name, title, version, date in _GNU:
        out += [(name, f"{title} Version {version}, {date}"), *((name, form.format(f"{title}, version {version}")) for form in _PLAIN)]
        out += [(name, form.format(thing, title, version)) for form in _GNU_HEADERS for thing in ("program", "library")]
    for name, title in (*_GNU_ANY, *_NAMED):
        out += [(name, form.format(title)) for form in _PLAIN]
    out += _NAMED
    for code, title in _CC:
        for end, version in _CC_VERSIONS:
            out += [(f"CC-{code}{end}", " ".join(form.format(name=title, version=version, code=code, number=end[1:]).split())) for form in _CC_FORMS]
            out += [(f"CC-{code}{end}", f"{title} {version}")] if end else []
    return out


#: (license, text)
FORMS = tuple(dict.fromkeys(_all()))
_GNU_NAMES = ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GFDL-1.2", "GFDL-1.3")
_CC_NAMES = tuple(dict.fromkeys(f"CC-{code}{end}" for code, _ in _CC for end, _ in _CC_VERSIONS if end))
_IDS = tuple(dict.fromkeys((*(name for name, _ in _NAMED), "WTFPL", "PSF-2.0", "Python-2.0", "NCSA", "Ruby", "PHP-3.01", "Artistic-1.0", "Apache-1.0", "MPL-1.0", "AFL-2.1", "OSL-2.1", "MIT-0", "BSD-1-Clause", "BSD-3-Clause-Clear", "BlueOak-1.0.0", "X11", *_CC_NAMES)))
#: (license, SPDX line); a line stands for a license only with all its words, as identifiers differ by a word.
SPDX = tuple((name, f"SPDX-License-Identifier: {x}") for name, x in (*((i, i) for i in _IDS), *((n, n + end) for n in _GNU_NAMES for end in ("", "-only", "-or-later"))))
