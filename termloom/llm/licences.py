"""Licence scan by canonical digests of entire texts.

A text's canonical form is lower-cased, without copyright lines and lines that only name the licence,
with every run of anything but letters and digits as one space, and with equivalent spellings
made alike. The SHA-256 of that form is joined with the digests of known licences. Two kinds of
entire text are looked up: the whole document, and each of its lines (for one-line notices).

Known by default are short licence texts and standard headers (``KNOWN``), one-line notices made
of ``SUBJECTS``, ``VERBS``, ``LINKS`` and ``NAMES``, identifier tags, and long texts by their digests alone
(``DIGESTS``). A table (``licence_id``, ``text``), such as ``read_licences`` gives for a folder of
licence files, replaces them. The digests are broadcast only if they measure small.
Lines are combined per document before the shuffle.

Nulls and repeats: a null text is empty; a text or line without letters or digits is no licence; two
known texts with the same canonical form give the smaller id. Every row gives one row, whatever
its id. Extra columns play no part.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import ROW, located, once, text_column
from termloom.plans.joins import fits_broadcast

# Lines that state a copyright and its holder, or only name a licence, in a lower-cased
# text.
_TITLES = (
    "mit", "mit no attribution", "mit-0", "expat", "isc", "x11", "zlib", "zlib/libpng", "bsd", "boost software",
    "(new|modified|revised|simplified|original) bsd", "([0-4]|zero|two|three|four)[- ]clause bsd",
    "bsd ([0-4]|zero|two|three|four)[- ]clause", "0bsd",
)
_OTHER_NAME = r"(new|revised|modified|simplified|freebsd)"
COPYRIGHT_LINE = (
    r"(?md)^[ \t*#/;-]*(portions )?(copyright|\(c\)|©)[^\n]*([0-9]{4}|\(c\)|©|<|\[)[^\n]*$"
    r"|(?md)^[ \t*#/;-]*copyright(:| by| the) [^\n]{1,80}$"
    r"|(?md)^[ \t*#/;-]*all rights reserved\.?[ \t]*$"
    rf"|(?md)^[ \t*#/;=-]*(the )?({'|'.join(_TITLES)})"
    rf'( "?{_OTHER_NAME}"?( or "?{_OTHER_NAME}"?)?)? licen[cs]e( \([^()\n]*\))?:?[ \t]*$'
)
OTHER = r"[^\p{L}\p{N}\n]+"
BREAK = r" *\n[ \n]*"
# Spellings taken as equal, after the published matching guidelines.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("noncommercial", "non commercial"),
    ("copyright owner", "copyright holder"),
    ("sub license", "sublicense"),
    ("per cent", "percent"),
)

_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT."""
_MIT_LIABILITY = """ IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF
THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_GRANT = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the
distribution.
"""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with
or without fee is hereby granted"""
_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU {kind}General Public License as published by the Free Software Foundation, either version
{version} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
{kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License along with this program. If
not, see <https://www.gnu.org/licenses/>."""

# Licence texts and standard headers as their stewards publish them.
KNOWN = (
    (
        "MIT",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
"""
        + _WARRANTY
        + _MIT_LIABILITY,
    ),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    (
        "BSD-3-Clause",
        _BSD_GRANT
        + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.
"""
        + _BSD_WARRANTY,
    ),
    (
        "ISC",
        "ISC License\n\n"
        + _ISC_GRANT
        + """, provided that the above copyright notice and this permission notice appear in all
copies.
"""
        + _ISC_WARRANTY,
    ),
    ("0BSD", "BSD Zero Clause License\n\n" + _ISC_GRANT + ".\n" + _ISC_WARRANTY),
    (
        "Zlib",
        """zlib License

This software is provided 'as-is', without any express or implied warranty. In no event will the
authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
the original software.

3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "MIT-0",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so.
"""
        + _WARRANTY
        + _MIT_LIABILITY,
    ),
    (
        "BSL-1.0",
        """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce,
display, distribute, execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the
following:

The copyright notices in the Software and this entire statement, including the above license grant,
this restriction and the following disclaimer, must be included in all copies of the Software, in
whole or in part, and all derivative works of the Software, unless such copies or derivative works
are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND
NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE
LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any
and all copyright interest in the software to the public domain. We make this dedication for the
benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
this software under copyright law.
"""
        + _WARRANTY
        + """ IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org/>""",
    ),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.""",
    ),
    *(
        (licence_id, _GNU_HEADER.format(version=version, kind=kind))
        for licence_id, version, kind in (
            ("GPL-2.0", "2", ""),
            ("GPL-3.0", "3", ""),
            ("LGPL-3.0", "3", "Lesser "),
            ("AGPL-3.0", "3", "Affero "),
        )
    ),
)

# What notices call the licences.
NAMES = (
    ("0BSD", ("Zero-Clause BSD License", "BSD Zero Clause License")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC0-1.0", ("CC0 1.0", "CC0 1.0 Universal License")),
    ("EPL-2.0", ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3")),
    ("ISC", ("ISC License",)),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3")),
    ("MIT", ("MIT License", "Expat License")),
    ("MIT-0", ("MIT No Attribution License", "MIT-0 License")),
    ("MPL-2.0", ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0")),
    ("Unlicense", ("Unlicense", "Unlicense License")),
    ("Zlib", ("zlib License", "zlib/libpng License")),
)
SUBJECTS = ("", "This work is", "This file is", "This project is", "This software is", "This program is", "It is")
VERBS = ("licensed under", "released under", "distributed under", "available under")
LINKS = ("", "the", "the terms of the")
TAG = "SPDX-License-Identifier:"

# SHA-256 of the canonical forms of long texts as their stewards publish them.
DIGESTS = (
    ("Apache-2.0", "8ccd7e2a87a615f12cc6b52b15625795b28c6d737d01b85bd89a974aaaf94ae8"),
    ("Artistic-1.0-Perl", "68b9dd49ed1b1348e977ccc2468570a603d8075ede45354e352319821ca5469a"),
    ("CC0-1.0", "5caa6b96e2c9f66e9ca02d726096312a8662a9c4fea6446ff24fee66902e58dc"),
    ("GFDL-1.2", "e9d37f1af9e55d1b29718ff0dd4e2583340a45ba56c062b54ac2bffa6b9184ac"),
    ("GFDL-1.3", "6fbbb28d155387ad69422adfd39ef7b89fc749edfdf997c7dd351c6158bd2298"),
    ("GPL-1.0", "369f57bee7b7b48d1dba46146a41780f056529a15e980c4d6843f83a58fcc2da"),
    ("GPL-2.0", "f75a1d6b2af9538af59deeb4d742cc70c58d0b8d134778479f26ecbd851b392f"),
    ("GPL-3.0", "1762992c0f76994ca6cd4de78ffa1345f8e322e1a230f87cf23660dac7bf8314"),
    ("LGPL-2.0", "4921f4e1e5e73369d202e5c7683c965b4d275ba35f23c50d389e92705d9cc84e"),
    ("LGPL-2.1", "a65b75d251fb56c535ec7079440f5d167ec95725dd20f1d16677176defe487a3"),
    ("LGPL-3.0", "572947626844a56d29ace510237040204d4085696621f319533ca366aa897913"),
    ("MPL-1.1", "776a2ea157df7658a757e03febae7d6b9a6bfe99bac417d7d78bab4c01042e8b"),
    ("MPL-2.0", "085a00a7d5f35fd39ee7b08052486f5758ccc298a989a6393e2ce3ead8160650"),
)


def notices() -> list[tuple[str, str]]:
    """Every one-line notice with the licence it means."""
    found = [(licence_id, f"{TAG} {licence_id}") for licence_id, _ in NAMES]
    for licence_id, names in NAMES:
        for name, subject, verb, link in product(names, SUBJECTS, VERBS, LINKS):
            found.append((licence_id, f"{subject} {verb} {link} {name}"))
    return found


def canonical_lines(text: Column) -> Column:
    """The canonical form with the text's line breaks; two spaces between a line's words."""
    kept = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    spaced = F.replace(F.regexp_replace(kept, OTHER, "  "), F.lit("\n"), F.lit(" \n "))
    out = F.concat(F.lit(" "), spaced, F.lit(" "))
    for pair in SPELLINGS:
        spelling, other = (F.lit(f" {words} ".replace(" ", "  ")[1:-1]) for words in pair)
        out = F.replace(out, spelling, other)
    return out


def flat(lines: Column) -> Column:
    """The canonical form of the whole text: its words with two spaces between."""
    return F.trim(F.regexp_replace(lines, BREAK, "  "))


def digest(canonical: Column) -> Column:
    return F.when(canonical != "", F.sha2(canonical.cast("binary"), 256))


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*KNOWN, *notices()], "licence_id string, text string")


def read_licences(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder as known licences, each named like its file, less ``.txt``."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "")
    return files.select(name.alias("licence_id"), F.col("value").alias("text"))


def digests_of(known: DataFrame) -> DataFrame:
    """``digest`` and ``licence_id`` of the known texts, one row a digest."""
    lines = known.select("licence_id", once(canonical_lines(text_column())).alias("lines"))
    return lines.select("licence_id", digest(flat(F.col("lines"))).alias("digest"))


def known_digests(spark: SparkSession) -> DataFrame:
    long_texts = spark.createDataFrame(list(DIGESTS), "licence_id string, digest string")
    return digests_of(known_licences(spark)).unionByName(long_texts)


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per row: ``canonical_sha256``, ``licence_id`` of the whole text, ``line_licences``, ``n_lines``.

    ``line_licences`` lists the ids found as entire lines, sorted and comma-joined.
    """
    digests = known_digests(docs.sparkSession) if known is None else digests_of(known)
    digests = digests.filter("digest is not null").groupBy("digest").agg(F.min("licence_id").alias("licence_id"))
    if fits_broadcast(digests):
        digests = F.broadcast(digests)
    lines = once(canonical_lines(text_column())).alias("lines")
    texts = located(docs).select(F.col("doc_id").cast("long"), *ROW, lines)
    whole = once(digest(flat(F.col("lines")))).alias("whole")
    texts = texts.select("doc_id", *ROW, "lines", whole)
    line = F.explode(F.split("lines", "\n")).alias("line")
    rows = texts.select("doc_id", *ROW, "whole", line)
    rows = rows.select("doc_id", *ROW, "whole", digest(F.trim("line")).alias("digest"))
    found = rows.join(digests.withColumnRenamed("licence_id", "line_id"), "digest", "left")
    grouped = found.groupBy(*ROW).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("whole").alias("whole"),
        F.array_sort(F.collect_set("line_id")).alias("ids"),
        F.count("line_id").alias("n_lines"),
    )
    joined = grouped.join(digests.withColumnRenamed("digest", "whole"), "whole", "left")
    return joined.select(
        "doc_id",
        *ROW,
        F.col("whole").alias("canonical_sha256"),
        "licence_id",
        F.concat_ws(",", "ids").alias("line_licences"),
        "n_lines",
    )
