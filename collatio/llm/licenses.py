"""Licence scans by canonical digest.

A text's canonical form has no copyright lines, title line, list marks, case, punctuation or spelling
variants; its SHA-256 is looked up among the digests of known licence texts by a hash join with the
catalogue, which is a fixed table. Lines that may be notices are looked up in the same catalogue, one by one.
Of short licences the catalogue has the texts themselves, of long ones their digests.

Only DataFrame functions run. Null texts have no digest and no licence; so have texts without any
letter or digit. Rows are independent: repeated rows get a row each, long texts are read whole. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence texts and the notices that refer to them.
KNOWN: tuple[tuple[str, str], ...] = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\nFor more information, please refer to <https://unlicense.org>"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
)
#: Spellings that count as the second one, between blanks.
SPELLINGS: tuple[tuple[str, str], ...] = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licence", "sublicense"), ("sublicence", "sublicense"),
    ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("per cent", "percent"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"),
)
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright (?:\(c\)|©|[0-9]{4}|\[y|<y)|©|\(c\) ?[0-9]{4}|all rights reserved)[^\n]*$"
#: The first line of a text, if it only names a licence.
TITLE_LINE = r"^[^\p{L}\p{N}]*(?:the )?(?:new |modified |simplified |revised )?(?:mit|isc|zlib|unlicense|0bsd|bsd|zero[ -]clause bsd|[023][ -]clause bsd|boost software|apache|mozilla public|gnu (?:lesser |library |affero )?general public)[^\n]{0,48}\n"
LIST_MARK = r"(?m)^[^\p{L}\p{N}\n]*(?:[0-9]{1,2}|[a-z])[.)] +"
NOTICE = "licen[sc]e"  # the SQL twin looks up lines with it alone


def canonical(text: Column) -> Column:
    out = F.lower(text)
    for pattern in (COPYRIGHT_LINE, TITLE_LINE, LIST_MARK):
        out = F.regexp_replace(out, pattern, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def canonical_here(text: str) -> str:
    """The same of an ASCII text, for the catalogue."""
    out = text.lower()
    for pattern in (COPYRIGHT_LINE, TITLE_LINE, LIST_MARK):
        out = re.sub(pattern.replace(r"\p{L}\p{N}", "A-Za-z0-9"), " ", out)
    out = " " + re.sub("[^a-z0-9]+", " ", out) + " "
    for old, new in SPELLINGS:
        out = out.replace(f" {old} ", f" {new} ")
    return re.sub(" +", " ", out).strip()


def digest_here(text: str) -> str:
    return hashlib.sha256(canonical_here(text).encode()).hexdigest()


#: Digests of the canonical forms of long licences as they are published.
PUBLISHED: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "efe9016df00706f076eed643a31535866e1254d860aedfab78b44e99f64af894"),
    ("Apache-2.0", "3a25ef1ea7b3c32f8435f633f2a01e239fedc21f89866084fd400d61f2fb0850"),
    ("Artistic-1.0", "4834e699353522cfb463bd8b374752ecf02156bb3f5dfb53d0edb502a112a651"),
    ("BSD-3-Clause", "d0a339eb5454123c6a1f2696aace557e0561866f3fe33b93ffad58ecfcab7060"),
    ("CC0-1.0", "888ab175b43ed137ae3c3f8f32a1f0e1677fe31f7a9f09890c39b11b1934ad6c"),
    ("GFDL-1.2", "66c938a4f3d2114cc3d60f4233a4f26e8c730064aa767788d4745dedea334da1"),
    ("GFDL-1.3", "3c375c0e780727eaa9ddb17a7fa022a4b0b7ed527f12a3da106f47b622a3b3f1"),
    ("GPL-1.0", "ccb759ed9f97b19013bbb75be2c230355e8b3993d435c1885559ea0b715b8cca"),
    ("GPL-2.0", "5ef1f5f0461a54997a170af5c87102900e651106207b80558de731fd1db30832"),
    ("GPL-3.0", "e5663b20b255ec5768c1bbce2bb32b32f86778c0a3e0c1155c38e2738eb047c6"),
    ("LGPL-2.0", "ffd8730789ab0fc5853425d608bf29d213379ce803c8549814e85648681ef32a"),
    ("LGPL-2.1", "0af47c8da0e16365147be761910b2af02249ed8ea2f5dbed0a027d6f7639058a"),
    ("LGPL-3.0", "26aeb5d3e16e4dee74aba841e3bb744f36eef8e902c291b36439a8a02441cb95"),
    ("MPL-1.1", "73511c29e26fb68e9989bd607c324f2ca21937d8f569a269c838f0a171cb5115"),
    ("MPL-2.0", "f01e89585ca9993f1590569122b28a274599068f1853884399a5acffa8bf9035"),
)

#: Digest and licence of each known text, with its line breaks and without.
CATALOGUE: tuple[tuple[str, str], ...] = tuple(dict.fromkeys([(digest_here(x), name) for name, t in KNOWN for x in (t, t.replace("\n", " "))] + [(d, name) for name, d in PUBLISHED]))

#: What each known text holds one of in any spelling: the word of NOTICE, or else the text's longest word that has one spelling.
GATE = "|".join(dict.fromkeys((NOTICE, *(max(set(c.split()) - {w for _, new in SPELLINGS for w in new.split()}, key=lambda w: (len(w), w)) for _, t in KNOWN for c in (canonical_here(t.replace("\n", " ")),) if not re.search(NOTICE, c)))))


def digest(text: Column) -> Column:
    """The SHA-256 of the canonical form; null where that is empty."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c, 256))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_digest, text_license and notice_licenses (sorted) of each row."""
    catalogue = F.broadcast(docs.sparkSession.createDataFrame(list(CATALOGUE), "known_digest string, text_license string"))
    known = F.create_map(*(F.lit(x) for pair in CATALOGUE for x in pair))
    t = F.col(f"`{text}`").cast("string")
    # Every known text holds a word of GATE, so other lines need no digest.
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"(?i){GATE}"))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda x: F.try_element_at(known, F.coalesce(digest(x), F.lit("")))), lambda x: x.isNotNull())))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), digest(t).alias("text_digest"), F.when(t.rlike(f"(?i){GATE}"), found).otherwise(F.array().cast("array<string>")).alias("notice_licenses"))
    return rows.join(catalogue, F.col("text_digest") == F.col("known_digest"), "left").select("doc_id", "text_digest", "text_license", "notice_licenses")
