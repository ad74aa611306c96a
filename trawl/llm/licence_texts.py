"""Known licence texts and one-line notices (fixed values: published texts).

The short texts are below; ``licences`` beside this file holds longer published texts, named by SPDX identifier.
"""

from importlib.resources import files

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""

_0BSD_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
"""

_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""

_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.
If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.
3. This notice may not be removed or altered from any source distribution.
"""

#: (licence, text) of whole texts; the names are SPDX identifiers.
TEXTS = (
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("MIT", _MIT_GRANT),
    ("ISC", "ISC License\n\n" + _ISC_GRANT + _ISC_WARRANTY),
    ("ISC", _ISC_GRANT + _ISC_WARRANTY),
    ("0BSD", "Zero-Clause BSD\n\n" + _0BSD_GRANT + _ISC_WARRANTY),
    ("0BSD", _0BSD_GRANT + _ISC_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_TERMS + _BSD_WARRANTY),
    ("BSD-2-Clause", _BSD_TERMS + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_TERMS + _BSD_NAMES + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TERMS + _BSD_NAMES + _BSD_WARRANTY),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("Zlib", _ZLIB),
)

END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def published() -> list[tuple[str, str]]:
    """(licence, text) of the files in ``licences``; also without what follows the end of the terms, unless that is
    an exception to them."""
    out = []
    for f in sorted(files(__package__).joinpath("licences").iterdir(), key=lambda f: f.name):
        if f.name.endswith(".txt"):
            name, text = f.name.removesuffix(".txt"), f.read_text("utf-8")
            terms = text if " WITH " in name else text.split(END_OF_TERMS)[0]
            out += [(name, t) for t in dict.fromkeys((text, terms, terms + END_OF_TERMS if terms != text else text))]
    return out


#: (licence, text) of one-line notices.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)
