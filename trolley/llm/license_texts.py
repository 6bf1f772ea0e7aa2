"""Notices and clauses of public licenses, by a short name."""

_AS_IS = "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"

TEMPLATES = {
    "0bsd": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO"
        " THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version. This program is distributed in the hope that it will be useful, but"
        " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        " PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "apache-2.0-contributors": (
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the"
        " NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF"
        " licenses this file to You under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License."
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "artistic-2.0-preamble": (
        "This license establishes the terms under which a given free software Package may be copied, modified,"
        " distributed, and/or redistributed. The intent is that the Copyright Holder maintains some artistic control"
        " over the development of that Package while still keeping the Package available as open source and free"
        " software."
    ),
    "boost-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
        " and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display,"
        " distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to"
        " permit third-parties to whom the Software is furnished to do so."
    ),
    "boost-1.0-line": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at"
        " http://www.boost.org/LICENSE_1_0.txt)"
    ),
    "bsd-3-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
        " products derived from this software without specific prior written permission."
    ),
    "bsd-4-advertising": (
        "All advertising materials mentioning features or use of this software must display the following"
        " acknowledgement: This product includes software developed by"
    ),
    "bsd-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED"
        " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
        " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
        " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
        " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
        " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING"
        " NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
        " POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-style-line": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."
    ),
    "cc-by-nd-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."
    ),
    "cc-by-sa-3.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "cc-by-sa-4.0-line": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "cc0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring"
        " rights to this software to the public domain worldwide. This software is distributed without any warranty."
        " You should have received a copy of the CC0 Public Domain Dedication along with this software."
    ),
    "cddl-1.0-header": (
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the"
        " \"License\"). You may not use this file except in compliance with the License."
    ),
    "curl": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies. THE"
        " SOFTWARE IS PROVIDED \"AS IS\", " + _AS_IS + ", INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT OF THIRD PARTY RIGHTS."
    ),
    "epl-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
        " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "gfdl-1.3-notice": (
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free"
        " Documentation License, Version 1.3 or any later version published by the Free Software Foundation; with no"
        " Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."
    ),
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details. You should have received a copy of the GNU General Public"
        " License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street,"
        " Fifth Floor, Boston, MA 02110-1301 USA."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "isc-disclaimer": (
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY"
        " DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE"
        " OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "lgpl-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or"
        " (at your option) any later version. This library is distributed in the hope that it will be useful, but"
        " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        " PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "lgpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software."
    ),
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", " + _AS_IS + ", INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
        " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,"
        " TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN"
        " THE SOFTWARE."
    ),
    "mit-line": "Released under the MIT License.",
    "mpl-1.1-header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not"
        " use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis,"
        " WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language governing"
        " rights and limitations under the License."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ofl-1.1-header": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and"
        " is also available with a FAQ at: https://scripts.sil.org/OFL"
    ),
    "postgresql": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without"
        " fee, and without a written agreement is hereby granted, provided that the above copyright notice and this"
        " paragraph and the following two paragraphs appear in all copies."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "unlicense-body": (
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "wtfpl": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and"
        " changing it is allowed as long as the name is changed."
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software. Permission is granted to anyone to use"
        " this software for any purpose, including commercial applications, and to alter it and redistribute it"
        " freely, subject to the following restrictions: The origin of this software must not be misrepresented; you"
        " must not claim that you wrote the original software. If you use this software in a product, an"
        " acknowledgment in the product documentation would be appreciated but is not required. Altered source"
        " versions must be plainly marked as such, and must not be misrepresented as being the original software."
        " This notice may not be removed or altered from any source distribution."
    ),
}
