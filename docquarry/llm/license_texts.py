"""Public licence texts and notices that the scan knows.

Short texts are given whole; their digests are made by the same steps as those
of documents. For long ones the digest of the canonical text is given.
"""

from __future__ import annotations

_MIT_BODY = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_ISC_BODY = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
_ZERO_BSD_BODY = _ISC_BODY.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.
"""
_UNLICENSE = """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_BOOST = """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

#: (licence id, whole text), with and without the usual titles
TEXTS: list[tuple[str, str]] = [
    *(("MIT", title + _MIT_BODY) for title in ("", "MIT License\n", "The MIT License\n", "The MIT License (MIT)\n")),
    *(("ISC", title + _ISC_BODY) for title in ("", "ISC License\n", "The ISC License\n")),
    *(("0BSD", title + _ZERO_BSD_BODY) for title in ("", "BSD Zero Clause License\n", "Zero-Clause BSD\n")),
    *(("BSD-2-Clause", title + _BSD_HEAD + _BSD_TAIL) for title in ("", "BSD 2-Clause License\n", "The 2-Clause BSD License\n")),
    *(("BSD-3-Clause", title + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL) for title in ("", "BSD 3-Clause License\n", "The 3-Clause BSD License\n")),
    *(("Zlib", title + _ZLIB) for title in ("", "zlib License\n")),
    *(("Unlicense", _UNLICENSE + end) for end in ("", "For more information, please refer to <https://unlicense.org>\n", "For more information, please refer to <http://unlicense.org/>\n")),
    *(("BSL-1.0", title + _BOOST) for title in ("", "Boost Software License - Version 1.0 - August 17th, 2003\n")),
]

#: Licence id by the digest of the canonical whole text.
DIGESTS: dict[str, str] = {
    "0009301c7bdf3e66178cde820563763716683e8b24a6ab45dd8548a6f4a3a0b9": "Apache-2.0",
    "9aae015a6322bbdec1a61c624a33b2c7d3b56283db1642e6e18d7820d4957b61": "GPL-2.0",
    "6ff3a9a8b11f055a64cb21003d19dbe88dd6a41f7487672c402dfe38b6fe2582": "GPL-3.0",
    "2f0a8618627c179dd830ddb8fa74635ae037468a5880f3b46a73915ae1990c24": "LGPL-2.0",
    "56d21d93f6012cbd7f1195b72528da245ccf843598ff833a87101eb36863f95b": "LGPL-2.1",
    "f0cae4b317f4f263dca8e79625f8d9c7618c87e0ca6665c79b0f1c12ac856938": "LGPL-3.0",
    "0ac61f2f49b44016379e89eb6a869e098cdbe0a797cf497618f3e8de3adaf375": "MPL-1.1",
    "b37263b1b2fae7b22e0bbbd4e1ef00041bda6d7c8df0fee3633b1f0362b35b7b": "MPL-2.0",
    "ab9e0a4960f3366c6e09c86510fe9dd469d242185a905b440792fcc4a45b46ef": "Artistic-1.0-Perl",
    "bd0e52fb1af40ab9797ba72f1d627b83d449e9926f66d21c51209413ac988137": "CC0-1.0",
    "8aeaf5e8e3488d7c9d65e8416c911f7fe37b3bd88429feabc64ec6283117b8eb": "GFDL-1.2",
    "fb286966d28cff8aa94a7303127495846303801d66ef183d841d5971038d2aa0": "GFDL-1.3",
    "3b7c00b08d5c6de2349faf7a31bb6e49ff8a2273a7cfdd16f96859720b00d9ef": "GPL-1.0",
    # the terms alone, without what tells how to apply them, with and without their last line
    "c7fe888d9d23c4c07cd61e6a47cf05b340259a86e492515346bf2721d7407456": "Apache-2.0",
    "28663a8ea03d79b53dae4204cf7af49d0f9f80dacb8d2ba3423ba3fb814e6d98": "Apache-2.0",
    "3c9f4977ae65ec51dce2737640196c8c2d45aa4ba394ba71168fae3b8a4cc93f": "GPL-2.0",
    "46f90fb5923e11bc5b072f6872fe391adbc25dd2046a33fe66ac15c717f3517f": "GPL-2.0",
    "5d527914d4539f34149cd198edb1e5de52322047d37781b3bd66403f12dc40e1": "GPL-3.0",
    "364b9ec532739b053b76aadd8eff2901d097a9b32b2c3b38b47f954a5b5e96b2": "GPL-3.0",
    "a7bd7bcc6f59de5c915482fc3cacdd5a1b6b27c24354df724c2ef3672dce9475": "LGPL-2.1",
    "d203bc167b87a561b06e0875df37e31508f1030f0b6c56bbfabc2f16acce8c65": "LGPL-2.1",
    "4c8deaf1fcf78762f3079aeb73e19e1b5ebdf1e0efedb3807b47eb8897d0819b": "EPL-2.0",
}

#: (licence id, one-line notice)
NOTICES: list[tuple[str, str]] = [
    *(("Apache-2.0", x) for x in ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");", "SPDX-License-Identifier: Apache-2.0", "This project is licensed under the Apache License 2.0.")),
    *(("MIT", x) for x in ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT", "MIT License", "The MIT License (MIT)")),
    *(("GPL-3.0", x) for x in ("This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License v3.0.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0")),
    *(("GPL-2.0", x) for x in ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: GPL-2.0")),
    *(("BSD-3-Clause", x) for x in ("SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD 3-Clause License.", "BSD 3-Clause License")),
    *(("BSD-2-Clause", x) for x in ("SPDX-License-Identifier: BSD-2-Clause", "Released under the BSD 2-Clause License.", "BSD 2-Clause License")),
    *(("MPL-2.0", x) for x in ("SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.")),
    *(("ISC", x) for x in ("SPDX-License-Identifier: ISC", "ISC License", "Released under the ISC License.")),
    *(("CC-BY-4.0", x) for x in ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "This work is licensed under CC BY 4.0.", "Licensed under CC BY 4.0.")),
    *(("CC-BY-SA-4.0", x) for x in ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "This work is licensed under CC BY-SA 4.0.", "Licensed under CC BY-SA 4.0.")),
    *(("CC0-1.0", x) for x in ("This work is licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0")),
]
