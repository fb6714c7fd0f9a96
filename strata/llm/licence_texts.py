"""What licences say of themselves in headers, and the whole texts of their files (long ones in ``texts``).

A new licence is a new entry; ``licences.scan`` takes any such table.
"""

from __future__ import annotations

from importlib.resources import files

WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

MIT = f"""MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{WARRANTY}"""

BSD_2 = f"""BSD 2-Clause License

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

{BSD_WARRANTY}"""

BSD_3 = BSD_2.replace("BSD 2-Clause", "BSD 3-Clause").replace(BSD_WARRANTY, f"""3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

{BSD_WARRANTY}""")

ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/."""

MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as
a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors."""

#: Licences by the names of the files in ``texts`` that have them.
FILED = ["Apache-2.0", "Artistic-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0"]


def whole_text(name: str) -> str:
    return files(__package__).joinpath("texts", f"{name}.txt").read_text(encoding="utf-8")


def gnu(kind: str, version: str, what: str = "program") -> list[str]:
    """What a header says of a GNU licence of a kind and version."""
    notice = GPL_NOTICE.replace("General", f"{kind} General".strip()).replace("version 3", f"version {version}").replace("program", what)
    short = f"{kind[:1]}GPL"
    return [f"This work is licensed under the GNU {kind} General Public License, version {version}.".replace("  ", " "),
        f"SPDX-License-Identifier: {short}-{version if '.' in version else version + '.0'}-or-later", notice.split("\n\n")[0], notice]


TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT", MIT],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", APACHE_NOTICE.split("\n\n")[0], APACHE_NOTICE],
    "GPL-3.0": gnu("", "3"), "GPL-2.0": gnu("", "2"), "GPL-1.0": [],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", *gnu("Lesser", "3", "library")],
    "LGPL-2.1": gnu("Lesser", "2.1", "library"), "LGPL-2.0": gnu("Library", "2", "library"),
    "GFDL-1.2": ["Licensed under the GNU Free Documentation License, Version 1.2."], "GFDL-1.3": ["Licensed under the GNU Free Documentation License, Version 1.3."],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause", BSD_2],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", BSD_3],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC", ISC],
    "MPL-2.0": ["SPDX-License-Identifier: MPL-2.0", MPL_NOTICE], "MPL-1.1": ["Licensed under the Mozilla Public License, Version 1.1."],
    "Artistic-1.0": ["Released under the Artistic License.", "SPDX-License-Identifier: Artistic-1.0"],
    "Unlicense": ["SPDX-License-Identifier: Unlicense", UNLICENSE],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["Copyright. All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited."],
}
for _name in FILED:
    TEMPLATES[_name].append(whole_text(_name))
#: What any licence may say beside its own terms: these are named only where nothing else is.
BOILERPLATE = ["Proprietary"]
