"""Known licences: published texts and notices, which have to be as they are. Fixed values.

The longer texts are the files in ``licenses/``, as published. To know another licence, add its file
to ``FILES`` and its lines to ``HEADERS`` and ``SPDX``.
"""

import re
from pathlib import Path

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

SHORT = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License (MIT)\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

#: Names of the files, and the licences they are.
FILES = (
    ("Apache-2.0", "Apache-2.0"), ("Artistic", "Artistic-1.0-Perl"), ("BSD-2-Clause", "BSD-2-Clause"), ("BSD-3-Clause", "BSD-3-Clause"),
    ("BSD-3-Clause-Regents", "BSD-3-Clause"), ("CC0-1.0", "CC0-1.0"), ("GFDL-1.2", "GFDL-1.2"), ("GFDL-1.3", "GFDL-1.3"), ("GPL-1", "GPL-1.0"),
    ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2", "LGPL-2.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"), ("MPL-1.1", "MPL-1.1"),
    ("MPL-2.0", "MPL-2.0"),
)

_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "You may obtain a copy of the License at",
    "http://www.apache.org/licenses/LICENSE-2.0",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
)


def _gnu(name: str, work: str, version: str, later: bool, ends: tuple[str, ...]) -> tuple[str, ...]:
    """The notice of a GNU licence, paragraph by paragraph, for each way to say where a copy is."""
    which = f"either version {version} of the License, or (at your option) any later version." if later else f"version {version} of the License."
    fitness = f"This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
    out = []
    for sign in (":", ";"):
        first = f"This {work} is free software{sign} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{';' if later else ','} {which}"
        for end in ends:
            out.append("\n\n".join((first, fitness, f"You should have received a copy of the GNU {name} along with this {work}{end}")))
    return (*out, first)


_WEB = (". If not, see <https://www.gnu.org/licenses/>.", ". If not, see <https://www.gnu.org/licenses/>")
_MAIL = (
    "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "; if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
)
#: Notices that the licences ask for: whole, and the paragraph that names the licence.
HEADERS = (
    ("Apache-2.0", "\n\n".join(_APACHE)),
    ("Apache-2.0", _APACHE[0]),
    ("MPL-2.0", " ".join(_MPL)),
    ("MPL-2.0", _MPL[0]),
    *(
        (f"{short}-{number}", text)
        for short, name, work, version, number in (
            ("GPL", "General Public License", "program", "2", "2.0"), ("GPL", "General Public License", "program", "3", "3.0"),
            ("LGPL", "Lesser General Public License", "library", "2.1", "2.1"), ("LGPL", "Lesser General Public License", "library", "3", "3.0"),
            ("LGPL", "Lesser General Public License", "program", "3", "3.0"), ("AGPL", "Affero General Public License", "program", "3", "3.0"),
        )
        for later in (True, False)
        for text in _gnu(name, work, version, later, _WEB + _MAIL)
    ),
)
#: Licences that an SPDX line may name as it is, and those of GNU, which say whether later versions hold.
SPDX = (
    "0BSD AFL-3.0 Apache-1.1 Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 "
    "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 "
    "CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 "
    "EUPL-1.1 EUPL-1.2 IPL-1.0 LPPL-1.3c MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.0 OFL-1.1 OSL-3.0 "
    "OpenSSL PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()
GNU = "AGPL-3.0 GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0".split()


def _published() -> list[tuple[str, str]]:
    """Each file, and the same without its appendix, its template of a copyright line or its numbers of clauses."""
    out = []
    for file, name in FILES:
        text = (Path(__file__).parent / "licenses" / file).read_text()
        out.append((name, text))
        head, mark, _ = text.partition("END OF TERMS AND CONDITIONS")
        if mark:
            out += [(name, head + mark), (name, head)]
        out.append((name, re.sub(r"(?m)^ *Copyright \[yyyy\].*$", "", text)))
        if name.startswith("BSD"):
            plain = re.sub(r"(?m)^ *(?:[0-9]\.|\*) +", "", text)
            numbers = iter("123")
            numbered = re.sub(r"(?m)^(?=Redistributions|Neither)", lambda _: f"{next(numbers)}. ", plain)
            out += [(name, plain), (name, numbered)]
            for title in {"BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License')}.get(name, ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License')):
                out += [(name, f"{title}\n\n{form}") for form in (text, plain, numbered)]
    return list(dict.fromkeys(out))


KNOWN = (
    *SHORT,
    *_published(),
    *HEADERS,
    *((name, f"SPDX-License-Identifier: {name}") for name in SPDX),
    *((name, f"SPDX-License-Identifier: {name}{which}") for name in GNU for which in ("", "+", "-only", "-or-later")),
)
