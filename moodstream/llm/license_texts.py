"""Notices and texts of common licences, as fixed values, with the words that tell them apart."""

import re

# Fixed values: (identifier, words that must be present in this order, wording).
TEMPLATES: list[tuple[str, str, str]] = [
    ("Apache-2.0", "apache license 2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "apache license 2.0", "This project is licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "apache license 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "mit license", "Released under the MIT License."),
    ("MIT", "mit license", "Licensed under the MIT License."),
    ("MIT", "mit licensed", "MIT-licensed"),
    ("MIT", "mit license", "This project is licensed under the MIT License."),
    (
        "MIT",
        "permission is hereby granted free of charge without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "GPL-3.0-or-later",
        "gnu general public license 3 any later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details.",
    ),
    ("MPL-2.0", "mozilla public license 2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    (
        "MPL-2.0",
        "mozilla public license 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("BSD-3-Clause", "bsd 3 clause license", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "bsd 2 clause license", "Licensed under the BSD 2-Clause License."),
    (
        "BSD-2-Clause",
        "redistribution and use in source and binary forms",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "redistribution and use in source and binary forms neither the name endorse",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "ISC",
        "permission to use copy modify with or without fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC0-1.0", "cc0 1.0", "Released under CC0 1.0."),
    ("Unlicense", "public domain", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "altered from any source distribution",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    ("BSL-1.0", "boost software license 1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "eclipse public license 2.0", "This program is made available under the terms of the Eclipse Public License 2.0."),
    ("WTFPL", "do what the fuck you want to", "You just do what the fuck you want to."),
]

# Families of licences, the words that tell them, and the versions there are; notices and identifiers follow by rule.
GNU = [
    ("GPL", "GNU General Public License", ("2", "3")),
    ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
    ("AGPL", "GNU Affero General Public License", ("3",)),
]
COMMONS = [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivs"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs"),
]
COMMONS_VERSIONS = ("2.0", "2.5", "3.0", "4.0")
IDENTIFIERS = (
    "Apache-2.0 MIT ISC Zlib BSL-1.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 BSD-2-Clause BSD-3-Clause CC0-1.0 Unlicense WTFPL 0BSD Artistic-2.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only "
    "AGPL-3.0-or-later"
).split()


def _told(text: str) -> str:
    """The words of a name, as telling words."""
    return " ".join(re.findall(r"\d+(?:\.\d+)*|[^\W\d_]+", text.lower()))


def _by_rule() -> list[tuple[str, str, str]]:
    out = []
    for short, name, versions in GNU:
        for version in versions:
            own = f"{short}-{version if '.' in version else version + '.0'}"
            out.append((own, _told(f"{name} {version}"), f"This work is licensed under the {name}, version {version}."))
            out.append((own, _told(f"{name} {version}"), f"Licensed under the {name} v{version}."))
            out.append((own, _told(f"{name} {version}"), f"{name} v{version}"))
    for short, name in COMMONS:
        for version in COMMONS_VERSIONS:
            own = f"CC-{short}-{version}"
            port = "International" if version == "4.0" else "Unported" if version == "3.0" else "Generic"
            out.append((own, _told(f"cc {short} {version}"), f"Licensed under CC {short} {version}."))
            out.append((own, _told(f"cc {short} {version}"), f"CC {short} {version}"))
            told = _told(f"creative commons {name} {version}")
            out.append((own, told, f"This work is licensed under a Creative Commons {name} {version} {port} License."))
    for own in IDENTIFIERS:
        out.append((own, _told(f"spdx license identifier {own}"), f"SPDX-License-Identifier: {own}"))
    return out


TEMPLATES += _by_rule()
