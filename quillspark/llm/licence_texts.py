"""Notices by licence family: what the classifier is trained on and predictions are confirmed with.

Fixed values: the notices as their publishers ask for them to be given, and the usual
one-line references.  Each string is one paragraph.
"""

NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under the CC0 1.0 Universal Public Domain Dedication.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

#: Paragraphs that use the same words and are no notice.
OTHERWISE: list[str] = [
    "The driver renewed his license at the office on the public square.",
    "A fishing license is required, and permission is granted by the warden.",
    "The general public was free to copy the notice from the board.",
    "Version 2 of the report was released under pressure in May.",
    "The foundation published the terms of the agreement in an international journal.",
    "Copyright law was changed again, and the court published its attribution of the work.",
    "The software was distributed without any warranty on the machine.",
    "The creative team shares common rights in the project and its documentation.",
    "All rights reserved.",
    "Her poetic license was a matter of style, the critics agreed.",
]
