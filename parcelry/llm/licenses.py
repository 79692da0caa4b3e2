"""License scan in DataFrame functions: MinHash bands over whole texts, verified by shingles.

Words are lower-cased runs of letters and digits, a shingle is the hash of five in a row. Templates are
partitioned by their words into classes, bound LEAST_WORDS * 2**c. A band is one row, whose minimum is the least of a
template's distinct shingles by the row's hash; a text shares the band if it has this shingle anywhere, which is as likely as
the share of the template it holds. A class has as many bands as make a miss of a text with NEAR of a template less
likely than MISS. Templates that share a band with a text are verified: the share of their distinct shingles that the
whole text has must reach NEAR, in one piece or with other words in between.

Templates are a query set and go into the plan in blocks of at most BLOCK_SHINGLES shingles; each block scans
the texts once, keeps the shared shingles of those with any in the shared folder, and shuffles nothing but the few candidates.

Defined cases: null texts and templates hold nothing; fewer words than five are one shingle of all of them and
match only a text of these words; templates of one name report once, by the best; repeated rows are reported once each;
whole texts are read; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.llm.common import NEAR, SHINGLE_WORDS, stored

LEAST_WORDS = 8
MISS = 1e-7
BLOCK_SHINGLES = 4096
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_BSD_OPENING = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_CONDITIONS = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GNU_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
    "Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."
)
#: Whole licence texts and the notices by which works name longer ones, by a short name.
TEMPLATES = (
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc-line", "Licensed under CC BY-NC 4.0."),
    ("gpl-3-line", "This work is licensed under the GNU General Public License, version 3."),
    ("mit-line", "Released under the MIT License."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("warranty", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"),
    ("mit-text", _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("mit-0-text", _MIT_GRANT + ". " + _AS_IS),
    ("bsd-2-text", _BSD_OPENING + _BSD_CONDITIONS + _BSD_AS_IS),
    ("bsd-3-text", _BSD_OPENING + _BSD_CONDITIONS + _BSD_NAMES + _BSD_AS_IS),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_AS_IS),
    ("0bsd-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_AS_IS),
    ("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("boost-1.0-text", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.'),
    ("unlicense-text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."),
    ("wtfpl-text", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."),
    ("apache-2.0-notice", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("gpl-2-notice", _GNU_NOTICE.format(name="GNU General Public License", version="2")),
    ("gpl-3-notice", _GNU_NOTICE.format(name="GNU General Public License", version="3")),
    ("lgpl-3-notice", _GNU_NOTICE.format(name="GNU Lesser General Public License", version="3")),
    ("agpl-3-notice", _GNU_NOTICE.format(name="GNU Affero General Public License", version="3")),
    ("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("epl-2.0-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("cc0-notice", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."),
    ("cc-by-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0-notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "template string, text string")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """Hashes of the runs of five words, in order; a single one for fewer words, none without words."""

    def of(w):
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - SHINGLE_WORDS + 1), lambda i: F.xxhash64(F.slice(w, i, SHINGLE_WORDS)))
        return F.when(F.size(w) >= SHINGLE_WORDS, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    # the words are bound to a name, lest they be split again for each use
    return F.transform(F.array(words(text)), of)[0]


def bands(bound: int, near: float = NEAR) -> int:
    """Bands that find a template of the class in a text that has it, but for MISS."""
    share = min(math.ceil(near * n) / n for n in range(1, bound - SHINGLE_WORDS + 2))
    return 1 if share == 1 else math.ceil(math.log(MISS) / math.log(1 - share))


def _least(grams: Column, count: Column) -> Column:
    """The shingle with the least hash of each band, each once."""
    salts = F.sequence(F.lit(1), count)
    return F.array_distinct(F.transform(salts, lambda salt: F.array_min(F.transform(grams, lambda g: F.struct(F.xxhash64(g, salt).alias("hash"), g.alias("gram"))))["gram"]))


def _blocks(listed: DataFrame) -> Iterator[list]:
    """Templates in blocks of a bounded number of shingles, one of more alone; the driver holds a block at a time."""
    block, size = [], 0
    for row in listed.toLocalIterator():
        if block and size + len(row["grams"]) > BLOCK_SHINGLES:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["grams"])
    if block:
        yield block


def scan(docs: DataFrame, known: DataFrame, key: str = "doc_id", name: str = "template") -> DataFrame:
    """(key, name, containment) of each text that holds NEAR or more of a template."""
    spark = docs.sparkSession
    listed = known.where(F.col("text").isNotNull()).select(name, F.size(words(F.col("text"))).alias("n"), F.array_distinct(shingles(F.col("text"))).alias("grams"))
    listed = listed.where(F.size("grams") > 0)
    numbered = F.monotonically_increasing_id()  # stands in the kept table of a block
    texts = docs.where(F.col("text").isNotNull()).select(F.col(key).alias("key"), numbered.alias("row"), "text")
    found = None
    for block in _blocks(listed.orderBy(name)):
        every = F.lit([int(g) for g in sorted({g for r in block for g in r["grams"]})]).cast("array<bigint>")
        # what the few texts with any shingle of the block share with it, kept so that texts are not scanned again
        grams = texts.select("key", "row", shingles(F.col("text")).alias("grams")).where(F.arrays_overlap("grams", every))
        held = stored(grams.select("key", "row", F.array_intersect("grams", every).alias("held")), "licensed")
        members = [(r[name], r["grams"], bands(LEAST_WORDS << max(0, math.ceil(math.log2(r["n"] / LEAST_WORDS))))) for r in block]
        table = spark.createDataFrame(members, f"{name} {known.schema[name].dataType.simpleString()}, template_grams array<bigint>, bands int")
        table = table.select(name, "template_grams", F.explode(_least(F.col("template_grams"), F.col("bands"))).alias("gram"))
        met = held.select("key", "row", "held", F.explode("held").alias("gram")).join(F.broadcast(table), "gram")
        share = F.size(F.array_intersect("held", "template_grams")) / F.size("template_grams")
        part = met.select("key", "row", name, share.alias("containment")).where(F.col("containment") >= NEAR)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.limit(0).select(key, F.lit(None).cast(known.schema[name].dataType).alias(name), F.lit(None).cast("double").alias("containment"))
    best = found.groupBy("row", name).agg(F.first("key").alias(key), F.max("containment").alias("containment"))
    return best.select(key, name, "containment")
