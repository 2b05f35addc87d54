"""Whole licenses, notices, passages and identifiers, the templates of the license scan.

Fixed values: label, key phrase that must stand there word for word, and the text around it.
"""

from __future__ import annotations

import re

PASSAGES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "the mit license", "the mit license mit copyright"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is", "the software is provided as is without warranty of any kind express or implied"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "apache org licenses", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "general public license", "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "gnu org licenses gpl", "you should have received a copy see https www gnu org licenses gpl"),
    ("lgpl", "lesser general public license", "gnu lesser general public license"),
    ("lgpl", "library general public license", "gnu library general public license"),
    ("agpl", "affero general public license", "gnu affero general public license"),
    ("gfdl", "free documentation license", "under the terms of the gnu free documentation license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "bsd license", "use of this source code is governed by a bsd style bsd license"),
    ("bsd", "bsd 3 clause", "licensed under the bsd 3 clause license"),
    ("bsd", "bsd 2 clause", "licensed under the bsd 2 clause license"),
    ("mpl", "mozilla public license", "mozilla public license v 2 0"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license version 2 0"),
    ("mpl", "mozilla org mpl", "you can obtain one at http mozilla org mpl 2 0"),
    ("epl", "eclipse public license", "eclipse public license"),
    ("epl", "eclipse org legal epl", "available at https www eclipse org legal epl"),
    ("isc", "isc license", "licensed under the isc license"),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "the unlicense", "released under the unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "do what the fuck you want to public license"),
    ("zlib", "zlib license", "licensed under the zlib license"),
    ("zlib", "in no event will the authors be held liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "boost software license", "distributed under the boost software license version 1 0"),
    ("artistic", "artistic license", "under the terms of the artistic license 2 0"),
    ("postgresql", "postgresql license", "released under the postgresql license"),
    ("python", "python software foundation license", "python software foundation license version 2"),
    ("openssl", "openssl license", "licensed under the openssl license"),
    ("cddl", "common development and distribution license", "subject to the terms of the common development and distribution license"),
    ("cpl", "common public license", "this program and the accompanying materials are made available under the common public license"),
    ("eupl", "european union public licence", "licensed under the european union public licence"),
    ("ms-pl", "microsoft public license", "microsoft public license ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal license ms rl"),
    ("ofl", "sil open font license", "licensed under the sil open font license version 1 1"),
    ("ncsa", "illinois ncsa open source license", "university of illinois ncsa open source license"),
    ("php", "php license", "this source file is subject to version 3 01 of the php license"),
    ("ruby", "ruby license", "distributed under the ruby license"),
    ("vim", "vim license", "distributed under the vim license"),
    ("cecill", "cecill license", "governed by the cecill license under french law"),
    ("afl", "academic free license", "licensed under the academic free license version 3 0"),
    ("osl", "open software license", "licensed under the open software license version 3 0"),
    ("upl", "universal permissive license", "licensed under the universal permissive license v 1 0"),
    ("ecl", "educational community license", "licensed under the educational community license version 2 0"),
    ("odbl", "open database license", "made available under the open database license"),
    ("busl", "business source license", "use of this software is governed by the business source license"),
    ("elastic", "elastic license", "licensed under the elastic license"),
    ("sspl", "server side public license", "server side public license"),
    ("mulan", "mulan psl", "licensed under mulan psl v2"),
    ("x11", "x11 license", "licensed under the x11 license"),
    ("libpng", "libpng license", "released under the libpng license"),
    ("sleepycat", "sleepycat license", "distributed under the sleepycat license"),
    ("0bsd", "zero clause bsd", "zero clause bsd license"),
    ("beerware", "beer ware license", "the beer ware license revision 42"),
    ("cc0", "public domain dedication", "creative commons zero public domain dedication"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    ("cc-by", "licensed under cc by 4 0", "licensed under cc by 4 0"),
    ("cc-by", "creative commons attribution 4 0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by-nd", "creative commons attribution noderivatives", "creative commons attribution noderivatives 4 0 international license"),
)

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_DISCLAIMS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT,
OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""

_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""

_HOLDERS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_FREE = """is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free
Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed in
the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
A PARTICULAR PURPOSE. See the GNU {} for more details."""

#: Licenses that are short enough to stand in a file, and the notices of those that are not, whole.
WHOLE = (
    ("mit", "permission is hereby granted free of charge", """Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. """ + _AS_IS),
    ("isc", "permission to use copy modify and or distribute this software", """Permission to use, copy, modify, and/or distribute this
software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. """ + _DISCLAIMS),
    ("0bsd", "with or without fee is hereby granted the software", """Permission to use, copy, modify, and/or distribute this software for
any purpose with or without fee is hereby granted. """ + _DISCLAIMS),
    ("bsd", "redistribution and use in source and binary forms", _CONDITIONS + _HOLDERS),
    ("bsd", "redistribution and use in source and binary forms", _CONDITIONS + _NAMES + _HOLDERS),
    ("zlib", "in no event will the authors be held liable", """This software is provided 'as-is', without any express or implied warranty. In no
event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to
use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution."""),
    ("unlicense", "free and unencumbered software", """This is free and unencumbered software released into the public domain. Anyone is free to
copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law. """ + _AS_IS),
    ("wtfpl", "do what the fuck you want to public license", """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING,
DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."""),
    ("boost", "boost software license", """Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge,
to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the
"Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"""),
    ("apache", "apache license", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""),
    *((label, key, _FREE.format(name, version, name)) for label, key, name, version in (
        ("gpl", "gnu general public license", "General Public License", 2),
        ("gpl", "gnu general public license", "General Public License", 3),
        ("lgpl", "gnu lesser general public license", "Lesser General Public License", 3),
        ("agpl", "gnu affero general public license", "Affero General Public License", 3),
    )),
    ("mpl", "mozilla public license", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
)

#: Identifiers that name a license wherever they stand, and those that do so only behind the tag.
NAMED = (
    ("apache", "apache 2 0"), ("gpl", "gpl 2 0"), ("gpl", "gpl 3 0"), ("gpl", "gnu gpl"), ("gpl", "gplv2"), ("gpl", "gplv3"), ("lgpl", "lgpl 2 1"),
    ("lgpl", "lgpl 3 0"), ("lgpl", "gnu lgpl"), ("agpl", "agpl 3 0"), ("agpl", "gnu agpl"), ("mpl", "mpl 2 0"), ("epl", "epl 1 0"), ("epl", "epl 2 0"),
    ("bsd", "bsd 2 clause"), ("bsd", "bsd 3 clause"), ("bsd", "bsd license"), ("0bsd", "bsd zero clause license"), ("cc-by", "cc by 4 0"),
    ("cc-by-sa", "cc by sa 4 0"), ("cc-by-nc", "cc by nc 4 0"), ("cc-by-nd", "cc by nd 4 0"), ("cc0", "cc0 1 0"), ("boost", "bsl 1 0"), ("artistic", "artistic 2 0"),
    ("osl", "osl 3 0"), ("afl", "afl 3 0"), ("eupl", "eupl 1 2"), ("ofl", "ofl 1 1"), ("cddl", "cddl 1 0"), ("upl", "upl 1 0"), ("ecl", "ecl 2 0"),
    ("mit", "apache 2 0 or mit"), ("mit", "mit or apache 2 0"), ("mit", "mit and bsd"), ("mit", "mit and apache 2 0"),
)
TAGGED = ("mit", "isc", "zlib", "unlicense", "wtfpl", "ncsa", "postgresql", "0bsd", "openssl", "x11", "libpng", "vim", "ruby", "beerware", "upl", "mulan", "php", "sleepycat")


def normal(text: str) -> str:
    return " ".join(re.findall(r"[0-9a-z]+", text.lower()))


TEMPLATES = (
    *PASSAGES,
    *((label, key, normal(text)) for label, key, text in WHOLE),
    *((label, words, words) for label, words in NAMED),
    *((label, f"spdx license identifier {label}", f"spdx license identifier {label}") for label in TAGGED),
)
