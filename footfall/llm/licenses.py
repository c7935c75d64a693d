"""License templates: notices, file headers and whole texts, and the words that name each.

``TEMPLATES`` maps a name to a text. ``NAMES`` holds phrases of a template, in its order,
that say which license and version it is; a text must have them word for word. A template
without an entry is known by its text alone. Whole texts of the GNU, Mozilla, Apache, CC0 and
Artistic licenses are files of ``license_texts``, as Debian distributes them in
``/usr/share/common-licenses``; the short ones are here. Of AGPL and the Creative Commons
licenses other than CC0 there are notices only.
"""

from __future__ import annotations

from pathlib import Path

_TEXTS = Path(__file__).with_name("license_texts")

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
    "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so"
)
_MIT_CONDITIONS = (
    ", subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted"
)
_ISC_CONDITIONS = (
    ", provided that the above copyright notice and this permission notice appear in all copies"
)
_ISC_AS_IS = (
    '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO '
    "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
    "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
    "OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means. In jurisdictions that recognize copyright laws, the author or authors of this "
    "software dedicate any and all copyright interest in the software to the public domain. We "
    "make this dedication for the benefit of the public at large and to the detriment of our "
    "heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law. "
)

TEMPLATES: dict[str, str] = {
    "MIT permission": _MIT + _MIT_CONDITIONS,
    "MIT": _MIT + _MIT_CONDITIONS + _AS_IS,
    "MIT-0": _MIT + "." + _AS_IS,
    "ISC": _ISC + _ISC_CONDITIONS + _ISC_AS_IS,
    "0BSD": _ISC + _ISC_AS_IS,
    "BSD-2-Clause": _BSD + _BSD_AS_IS,
    "BSD-3-Clause": _BSD + _BSD_THIRD + _BSD_AS_IS,
    "Unlicense": _UNLICENSE + _AS_IS.split(" IN THE SOFTWARE")[0],
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
}
NAMES: dict[str, tuple[str, ...]] = {
    "BSD-3-Clause": ("endorse or promote products derived from this software",),
    "Apache-2.0 header": ("Apache License, Version 2.0",),
    "MPL-2.0 header": ("Mozilla Public License, v. 2.0",),
}


def _add(name: str, text: str, *names: str) -> None:
    TEMPLATES[name], NAMES[name] = text, names


for _id, _name in (
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("BSD", "BSD License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC0-1.0", "CC0 1.0"),
):
    _article = "" if _id == "CC0-1.0" else "the "
    _add(f"{_id} notice", f"Released under {_article}{_name}.", _name)
for _id, _name in (
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("MPL-1.1", "Mozilla Public License, Version 1.1"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
):
    _add(f"{_id} notice", f"Licensed under the {_name}.", _name)
for _id, _name, _version, _what in (
    ("GPL-1.0", "GNU General Public License", "1", "program"),
    ("GPL-2.0", "GNU General Public License", "2", "program"),
    ("GPL-3.0", "GNU General Public License", "3", "program"),
    ("LGPL-2.0", "GNU Library General Public License", "2", "library"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "library"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "library"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "program"),
):
    _full = f"{_name}, version {_version}"
    _add(f"{_id} notice", f"This work is licensed under the {_full}.", _full)
    _add(
        f"{_id} header",
        f"This {_what} is free software: you can redistribute it and/or modify it under the "
        f"terms of the {_name} as published by the Free Software Foundation, "
        f"either version {_version} of the License, or (at your option) any later version.",
        _name,
        f"version {_version} of the License",
    )
_KINDS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _long in _KINDS.items():
    for _version in ("2.0", "2.5", "3.0", "4.0"):
        _id = f"CC-{_kind}-{_version}"
        _brief, _full = f"CC {_kind} {_version}", f"Creative Commons {_long} {_version}"
        _add(f"{_id} notice", f"Licensed under {_brief}.", _brief)
        _add(f"{_id} long notice", f"This work is licensed under a {_full} License.", _full)
for _id, _name in (
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Artistic-1.0", "Artistic License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3"),
    ("GPL-1", "GNU General Public License Version 1"),
    ("GPL-2", "GNU General Public License Version 2"),
    ("GPL-3", "GNU General Public License Version 3"),
    ("LGPL-2", "GNU Library General Public License Version 2"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-3", "GNU Lesser General Public License Version 3"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
):
    _spdx = _id if "." in _id else f"{_id}.0"
    _add(_spdx, (_TEXTS / f"{_id}.txt").read_text("utf-8", errors="replace"), _name)
