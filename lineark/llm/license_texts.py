"""Whole licenses in the markup of ``license_scan``.

Wording is mandatory but for titles, copyright lines, list marks and names: titles and copyright
lines may be absent, marks and names may be replaced.
"""

_MARK = "<<var;min=0;max=1>>"
_NAME = "<<var;min=1;max=12>>"


def _maybe(text: str) -> str:
    return f"<<beginOptional>>{text}<<endOptional>>"


def _headed(title: str, text: str) -> str:
    rights = _maybe("All rights reserved.")
    return f'{_maybe(title)} {_maybe(f"Copyright {_NAME} {rights}")} {text}'


# Wording that several licenses share.
_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
    'to permit persons to whom the Software is furnished to do so')
_NOTICE = (
    f', subject to the following conditions: The above copyright notice and this permission notice {_maybe("(including the next paragraph)")} '
    'shall be included in all copies or substantial portions of the Software.')
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    'THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL ')
_CLAIM = (
    ' BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING '
    'FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_FEE = (
    f'Permission to use, copy, modify, {_maybe("and/or")} {_maybe("and")} distribute this software for any purpose with or without fee is '
    'hereby granted')
_DISCLAIMS = (
    f'THE SOFTWARE IS PROVIDED "AS IS" AND {_NAME} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    f'IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {_NAME} BE LIABLE FOR ANY SPECIAL, DIRECT, '
    'INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN '
    'AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR '
    'PERFORMANCE OF THIS SOFTWARE.')
_TWO_CLAUSES = (
    'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
    f'following conditions are met: {_MARK} Redistributions of source code must retain the above copyright notice, this '
    f'list of conditions and the following disclaimer. {_MARK} Redistributions in binary form must reproduce the above '
    'copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials '
    'provided with the distribution.')
_THIRD_CLAUSE = (
    f'{_MARK} Neither the name of {_NAME} nor the names of {_NAME} may be used to endorse or promote products derived '
    'from this software without specific prior written permission.')
_DISCLAIMED = (
    f'THIS SOFTWARE IS PROVIDED BY {_NAME} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    'THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL '
    f'{_NAME} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT '
    'NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
    'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT '
    '(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE '
    'POSSIBILITY OF SUCH DAMAGE.')

# Licenses and their labels, as public license lists give them.
LICENSES = (
    ("mit", _headed("The MIT License (MIT)", _GRANT + _NOTICE + " " + _AS_IS + "THE AUTHORS OR COPYRIGHT HOLDERS" + _CLAIM)),
    ("mit-0", _headed("MIT No Attribution", _GRANT + ". " + _AS_IS + "THE AUTHORS OR COPYRIGHT HOLDERS" + _CLAIM)),
    ("x11", _headed("X11 License", _GRANT + _NOTICE + " " + _AS_IS + _NAME + _CLAIM + (
        f' Except as contained in this notice, the name of {_NAME} shall not be used in advertising or otherwise to promote '
        f'the sale, use or other dealings in this Software without prior written authorization from {_NAME}'))),
    ("isc", _headed("ISC License", _FEE + (
        ', provided that the above copyright notice and this permission notice appear in all copies. ') + _DISCLAIMS)),
    ("0bsd", _headed("Zero-Clause BSD", _FEE + ". " + _DISCLAIMS)),
    ("bsd-2-clause", _headed("BSD 2-Clause License", _TWO_CLAUSES + " " + _DISCLAIMED)),
    ("bsd-3-clause", _headed("BSD 3-Clause License", _TWO_CLAUSES + " " + _THIRD_CLAUSE + " " + _DISCLAIMED)),
    ("zlib", _headed("zlib License", (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        'liable for any damages arising from the use of this software. Permission is granted to anyone to use this software '
        'for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the '
        f'following restrictions: {_MARK} The origin of this software must not be misrepresented; you must not claim that you '
        'wrote the original software. If you use this software in a product, an acknowledgment in the product documentation '
        f'would be appreciated but is not required. {_MARK} Altered source versions must be plainly marked as such, and must '
        f'not be misrepresented as being the original software. {_MARK} This notice may not be removed or altered from any '
        'source distribution.'))),
    ("bsl-1.0", _headed("Boost Software License - Version 1.0 - August 17th, 2003", (
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and '
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
        'execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties '
        'to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software '
        'and this entire statement, including the above license grant, this restriction and the following disclaimer, must '
        'be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless '
        'such copies or derivative works are solely in the form of machine-executable object code generated by a source '
        'language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        'BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND '
        'NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY '
        'DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE '
        'SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'))),
    ("unlicense", (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, '
        'use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any '
        'purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the '
        'author or authors of this software dedicate any and all copyright interest in the software to the public domain. '
        'We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. '
        'We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to '
        'this software under copyright law. ') + _AS_IS + "THE AUTHORS" + _CLAIM + " " + _maybe(
        f'For more information, please refer to {_maybe("http")} {_maybe("https")} unlicense.org')),
    ("postgresql", _headed("PostgreSQL License", (
        'Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, '
        'and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and '
        f'the following two paragraphs appear in all copies. IN NO EVENT SHALL {_NAME} BE LIABLE TO ANY PARTY FOR DIRECT, '
        'INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS '
        f'SOFTWARE AND ITS DOCUMENTATION, EVEN IF {_NAME} HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. {_NAME} '
        'SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND '
        'FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN "AS IS" BASIS, AND '
        f'{_NAME} HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS.'))),
    ("ntp", _headed("NTP License", (
        'Permission to use, copy, modify, and distribute this software and its documentation for any purpose with or '
        'without fee is hereby granted, provided that the above copyright notice appears in all copies and that both the '
        f'copyright notice and this permission notice appear in supporting documentation, and that the name {_NAME} not be '
        'used in advertising or publicity pertaining to distribution of the software without specific, written prior '
        f'permission. {_NAME} makes no representations about the suitability {_maybe("of")} this software for any purpose. '
        'It is provided "as is" without express or implied warranty.'))),
    ("fsfap", _headed("", (
        'Copying and distribution of this file, with or without modification, are permitted in any medium without royalty '
        'provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.'))),
    ("apache-2.0-header", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        f'with the License. You may obtain a copy of the License at {_maybe("http")} {_maybe("https")} www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed '
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        'the specific language governing permissions and limitations under the License.')),
    ("gpl-header", (
        f'{_maybe("This program")} is free software; you can redistribute it and/or modify it under the terms of the GNU General Public '
        'License as published by the Free Software Foundation; either version <<var;min=1;max=1>> of the License, or (at '
        f'your option) any later version. {_NAME} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; '
        'without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General '
        'Public License for more details.')),
)
