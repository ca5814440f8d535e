"""The license statements, notices and texts that the registered scan looks for.

``STATEMENTS`` are found word for word, ``NAMES`` likewise where one of
``LEADS`` goes before (``under the``, ``copy of the``, ...), and ``TEXTS`` by
the share of their shingles. Each license has several wordings, of which one is
enough. Letter case, punctuation and line breaks do not count.
"""

from __future__ import annotations

LEADS = ("under", "under the", "under a", "terms of", "terms of the", "terms of a", "conditions of the", "provisions of the",
         "copy of the", "governed by the", "covered by the", "subject to the", "license", "license is", "license is the",
         "licence", "licence is the", "spdx license identifier")
#: for names that are common words or letters by themselves
_NARROW_LEADS = ("licensed under", "licensed under the", "released under", "released under the", "distributed under",
                 "distributed under the", "available under", "available under the", "license", "licence",
                 "spdx license identifier")


def _versions(names: tuple[str, ...], *numbers: str) -> list[str]:
    return [f.format(name, n) for name in names for n in numbers for f in (
        "{} version {}", "{} v{}", "{} v {}", "{} {}", "{} {} license", "version {1} of the {0}")]


def _gnu(name: str, short: str, major: str, *numbers: str) -> list[str]:
    by = " as published by the free software foundation"
    return (_versions((f"gnu {name}", f"{name}", f"gnu {short}", short), *numbers)
            + [f"gnu {name}{by} {either}version {n}" for n in numbers for either in ("", "either ")]
            + [f"gnu {name} as published by the fsf {either}version {n}" for n in numbers for either in ("", "either ")]
            + [f"{short}v{major}", f"gnu {short}v{major}", f"{short} {major} or later", f"{short} {major} only"])


def _creative(kind: str, short: str, number: str) -> list[str]:
    kinds = (kind, f"{kind} international", f"{kind} unported")
    long = [f"creative commons {kind} {number}{area}{last}" for area in ("", " international", " unported")
            for last in ("", " license", " licence", " public license")]
    return long + [f"creative commons {k} license" for k in kinds] + [f"cc {short} {number}", f"creative commons {short} {number}"]


_GPL, _LGPL, _AGPL = "general public license", "lesser general public license", "affero general public license"

#: forms of the names, to follow a lead
NAMES: dict[str, list[str]] = {
    "MIT": ["mit license", "mit licence", "mit expat license", "expat license", "mit x11 license", "mit open source license"],
    "Apache-2.0": _versions(("apache license", "apache licence", "apache software license", "apache public license", "apache"),
                            "2.0", "2") + ["asl 2.0", "apache2 license"],
    "Apache": ["apache license", "apache licence", "apache software license"],
    "GPL-2.0": _gnu(_GPL, "gpl", "2", "2", "2.0"),
    "GPL-3.0": _gnu(_GPL, "gpl", "3", "3", "3.0"),
    "GPL": [f"gnu {_GPL}", "gnu gpl", "gpl license", "gpl licence", "gpl"],
    "LGPL-2.1": _gnu(_LGPL, "lgpl", "2.1", "2.1"),
    "LGPL-3.0": _gnu(_LGPL, "lgpl", "3", "3", "3.0"),
    "LGPL": [f"gnu {_LGPL}", "gnu library general public license", "gnu lgpl", "lgpl license", "lgpl licence", "lgpl"],
    "AGPL-3.0": _gnu(_AGPL, "agpl", "3", "3", "3.0"),
    "AGPL": [f"gnu {_AGPL}", "gnu agpl", "agpl license", "agpl licence", "agpl"],
    "GFDL": ["gnu free documentation license", "gnu fdl", "gfdl"],
    "BSD-2-Clause": ["bsd 2 clause license", "bsd 2 clause", "2 clause bsd license", "two clause bsd license",
                     "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "bsd 3 clause", "3 clause bsd license", "three clause bsd license",
                     "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD": ["bsd license", "bsd licence", "bsd style license", "bsd"],
    "ISC": ["isc license", "isc licence"],
    "MPL-2.0": _versions(("mozilla public license", "mozilla public licence", "mpl"), "2.0", "2"),
    "MPL-1.1": _versions(("mozilla public license", "mpl"), "1.1"),
    "MPL": ["mozilla public license", "mozilla public licence", "mpl"],
    "EPL-1.0": _versions(("eclipse public license", "epl"), "1.0"),
    "EPL-2.0": _versions(("eclipse public license", "epl"), "2.0", "2"),
    "EPL": ["eclipse public license", "epl"],
    "EUPL": ["european union public licence", "european union public license", "eupl"],
    "CDDL": ["common development and distribution license", "cddl"],
    "Artistic-2.0": ["artistic license 2.0", "artistic license version 2.0"],
    "Artistic": ["artistic license"],
    "BSL-1.0": _versions(("boost software license", "bsl"), "1.0") + ["boost software license"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
    "OFL-1.1": _versions(("sil open font license", "open font license", "ofl"), "1.1") + ["sil open font license"],
    "ODbL": ["open database license", "odbl", "odc open database license"],
    "CC0-1.0": ["cc0", "cc0 1.0", "cc0 1.0 universal", "creative commons zero", "creative commons cc0"],
    "CC": ["creative commons license", "creative commons licence"],
} | {
    f"CC-{short.upper().replace(' ', '-')}-{number}": _creative(kind, short, number)
    for number in ("4.0", "3.0", "2.5", "2.0") for short, kind in (
        ("by", "attribution"), ("by sa", "attribution sharealike"), ("by nd", "attribution noderivatives"),
        ("by nc", "attribution noncommercial"), ("by nc sa", "attribution noncommercial sharealike"),
        ("by nc nd", "attribution noncommercial noderivatives"))
}
# forms without a number name no version
for _name in [n for n in NAMES if n.startswith("CC-")]:
    _plain = [f for f in NAMES[_name] if not any(c.isdigit() for c in f)]
    NAMES[_name] = [f for f in NAMES[_name] if f not in _plain]
    NAMES[_name.rsplit("-", 1)[0]] = _plain + [f"cc {_name[3:].rsplit('-', 1)[0].lower().replace('-', ' ')}"]

_NARROW = {"MIT": ["mit"], "ISC": ["isc"], "Zlib": ["zlib"]}

#: statements that need no lead: titles, links, notices
_AS_THEY_ARE = {
    "All-rights-reserved": ["All rights reserved", "All rights are reserved", "Alle Rechte vorbehalten",
                            "Tous droits réservés", "Todos los derechos reservados"],
    "MIT": ["MIT License Copyright", "The MIT License MIT", "opensource.org/licenses/MIT", "opensource.org/license/mit",
            "MIT licensed"],
    "Apache-2.0": ["Apache License Version 2.0 January 2004", "apache.org/licenses/LICENSE-2.0"],
    "GPL-2.0": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "gnu.org/licenses/gpl-2.0",
                "gnu.org/licenses/old-licenses/gpl-2.0"],
    "GPL-3.0": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gnu.org/licenses/gpl-3.0"],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", "gnu.org/licenses/old-licenses/lgpl-2.1"],
    "LGPL-3.0": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "gnu.org/licenses/lgpl-3.0"],
    "AGPL-3.0": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", "gnu.org/licenses/agpl-3.0"],
    "GFDL": ["GNU Free Documentation License Version 1", "gnu.org/licenses/fdl"],
    "MPL-2.0": ["Mozilla Public License Version 2.0 1. Definitions", "mozilla.org/MPL/2.0"],
    "MPL-1.1": ["MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions", "mozilla.org/MPL/1.1"],
    "BSD-2-Clause": ["BSD 2-Clause License Copyright", "opensource.org/licenses/BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License Copyright", "opensource.org/licenses/BSD-3-Clause"],
    "ISC": ["ISC License Copyright", "opensource.org/licenses/ISC"],
    "EPL-2.0": ["Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM", "eclipse.org/legal/epl-2.0", "eclipse.org/legal/epl-v20"],
    "EPL-1.0": ["Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM", "eclipse.org/legal/epl-v10"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003", "boost.org/LICENSE_1_0"],
    "Unlicense": ["unlicense.org", "This is free and unencumbered software released into the public domain"],
    "CC0-1.0": ["CC0 1.0 Universal", "creativecommons.org/publicdomain/zero/1.0", "waived all copyright and related"],
    "Public-domain": ["released into the public domain", "dedicated to the public domain", "placed in the public domain",
                      "is in the public domain", "released to the public domain"],
} | {
    f"CC-{code.upper()}-{number}": [f"creativecommons.org/licenses/{code}/{number}"]
    for code in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd") for number in ("4.0", "3.0", "2.5", "2.0")
}

STATEMENTS: dict[str, list[str]] = {name: [
    *(f"{lead} {form}" for lead in _NARROW_LEADS for form in _NARROW.get(name, [])),
    *_AS_THEY_ARE.get(name, [])] for name in {**_NARROW, **_AS_THEY_ARE}}

_AS_IS_AUTHORS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")

TEXTS: dict[str, list[str]] = {
    "MIT-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
        _AS_IS_AUTHORS],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "BSD-3-Clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Neither the name of the University nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE."],
    "Apache-2.0": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or "
        "Object form."],
    "GPL": [
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
        "General Public License is intended to guarantee your freedom to share and change free software",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "AGPL-3.0": [
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to "
        "whom the Software is furnished to do so"],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions"],
    "Unlicense": [
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "OFL-1.1": [
        "The goals of the Open Font License (OFL) are to stimulate worldwide development of collaborative font projects"],
}
