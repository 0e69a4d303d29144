"""Licence scan by canonical digests: normalised entire texts, and entire lines of them, hash-joined to the digests of known licences."""

from __future__ import annotations

import re
from hashlib import md5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, row_key

#: Words that mean the same in a licence.
EQUIVALENT = [("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("http", "https"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("fulfil", "fulfill"), ("analogue", "analog")]
#: Names and texts of short licences and notices.
KNOWN = [
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("MIT-0", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("AllRightsReserved", "All rights reserved."),
]
#: Licences whose texts are long, by the canonical digest of the whole text, and of its terms without the appendix on their use.
LONG = [
    ("Apache-2.0", "whole", "6fc27425ff10f40f194a4ea601731162"),
    ("Apache-2.0", "terms", "71b2bd815104b9a01c3f714eb505d24b"),
    ("Artistic-1.0-Perl", "whole", "01297679267ad921516667ccd889865e"),
    ("BSD-3-Clause", "whole", "ddcd765ed0a3236bf96e15f76c36983a"),
    ("CC0-1.0", "whole", "93a180096f6cfcf2c0dd24f75c2eec48"),
    ("GFDL-1.2", "whole", "c969fdb4b731dadf7173c1ffbe49a117"),
    ("GFDL-1.3", "whole", "eb6b86c0fad89753a5a36c484fa0ada2"),
    ("GPL-1.0", "whole", "738cc3b112640d95d4cd79a58967ecea"),
    ("GPL-1.0", "terms", "dbf3c47f5a8f127e58d08cabc1ebb916"),
    ("GPL-2.0", "whole", "5e39ace6e62f5a7fe9c17b4da986ad8c"),
    ("GPL-2.0", "terms", "68380dbeadb093b94ecf563db7312db7"),
    ("GPL-3.0", "whole", "5eaa767cc0a56c87c3852144458a3bf1"),
    ("GPL-3.0", "terms", "444f95dc767ede978b60cfb20fbd0bca"),
    ("LGPL-2.0", "whole", "74cf7fcef3b29a39165a795b2cad3a3a"),
    ("LGPL-2.0", "terms", "c396ba2f94537628797123bc12cd2d6e"),
    ("LGPL-2.1", "whole", "f998bc436710cfece156aaa84fd26dd4"),
    ("LGPL-2.1", "terms", "3054b3781b1af43f906dc753acad15ee"),
    ("LGPL-3.0", "whole", "b31b7335bc37919e8cdd79154e04d88d"),
    ("MPL-1.1", "whole", "252dfbcf46f9012c7c356a9252f1c30c"),
    ("MPL-2.0", "whole", "db12a21e89062c14ac06f7d6aa8123d5"),
]
#: Normalised lines that only name who holds the rights, or head a licence.
_NOTICE = r"^(portions )?(copyright( c)*|c) (by )?[0-9]{4}( .*)?$|^(portions )?copyright c( .*)?$|^copyright( [^ ]+){1,8} all rights reserved$|^all rights reserved$|^(the )?(mit|isc|zlib|unlicense|boost software|bsd [23] clause) license( mit| isc| zlib)?$"
_OTHER = "[^a-z0-9]+"


def _line(c: Column) -> Column:
    """A line in lower case, the copyright sign as the word, with runs of other than letters and digits as one space."""
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("\u00a9"), F.lit(" copyright ")), _OTHER, " "))


def _spelled(c: Column) -> Column:
    """Normalised words with one spelling of each."""
    same = c
    for a, b in EQUIVALENT:
        same = F.regexp_replace(same, rf"\b{a}\b", b)
    return F.when(c.rlike(rf"\b({'|'.join(a for a, _ in EQUIVALENT)})\b"), same).otherwise(c)


def canonical_of(text: str) -> str:
    """The canonical form of a known text, on the driver; :func:`scan` has the same for columns."""
    lines = [re.sub(_OTHER, " ", x.lower().replace("\u00a9", " copyright ")).strip() for x in text.split("\n")]
    out = " ".join(x for x in lines if x and not re.search(_NOTICE, x)) or " ".join(filter(None, lines))
    for a, b in EQUIVALENT:
        out = re.sub(rf"\b{a}\b", b, out)
    return out


def known_digests() -> list[tuple[str, str]]:
    """(digest, license) of each of :data:`KNOWN` and :data:`LONG`."""
    out: dict[str, str] = {d: name for name, _, d in LONG}
    for name, text in KNOWN:
        d = md5(canonical_of(text).encode()).hexdigest()
        out[d] = min(out.get(d, name), name)
    return sorted(out.items())


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n", -1), _line), lambda x: x != "")


def _whole(lines: Column) -> Column:
    """The canonical digest of an entire text."""
    return F.md5(_spelled(F.array_join(F.filter(lines, lambda x: ~x.rlike(_NOTICE)), " ")))


def digests_of(texts: DataFrame) -> DataFrame:
    """(digest, license) of a table of licences (license, text) of any size, such as a public list of them, for :func:`scan`."""
    return texts.select(_whole(_lines(F.col("text"))).alias("digest"), F.col("license").cast("string").alias("license"))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, digest, license, notices.

    ``license`` names the known licence that the entire text is, its copyright lines aside, else null; ``digest`` is that of the
    canonical text. ``notices`` names, sorted and once each, the licences that an entire line of the text is. ``known`` (digest, license)
    is a table of any size; where it names two licences for a digest the first by name holds. Null or empty text: the digest of nothing, no
    licence, no notices. A null doc_id stays null. Repeated rows come back as often as they came. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(known_digests(), "digest string, license string") if known is None else known
    known = known.dropna(subset=["digest", "license"]).groupBy("digest").agg(F.min("license").alias("license"))
    base = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    base = base.withColumn("lines", _lines(F.col("text")))
    whole = _whole(F.col("lines"))
    each = F.array_distinct(F.transform("lines", lambda x: F.md5(_spelled(x))))
    # texts are normalised once; what the joins read are digests
    digests = Scratch(spark).table(base.select("id", "text_hash", "doc_id", whole.alias("digest"), each.alias("lines")), "digests")
    hits = digests.select("id", "text_hash", F.explode("lines").alias("digest")).join(known, "digest")
    notices = hits.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("license")).alias("notices"))
    out = digests.drop("lines").join(known, "digest", "left").join(notices, ["id", "text_hash"], "left")
    return out.select("doc_id", "digest", "license", F.coalesce("notices", F.array().cast("array<string>")).alias("notices"))
