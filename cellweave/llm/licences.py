"""Licence texts by the digest of their canonical form."""

from __future__ import annotations

import re
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.session import sized_join

col, lit = F.col, F.lit

#: Words that count as the same, after punctuation is gone.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "categorise": "categorize", "centre": "center", "colour": "color", "copyright": "c",
    "emphasised": "emphasized", "favour": "favor", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "maximise": "maximize", "merchantability": "merchantability",
    "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "noncommercial": "non commercial",
    "noninfringement": "non infringement", "sublicense": "sub license", "https": "http",
}

_PERMIT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_AS_IS_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
#: Licence texts and notices, without their copyright lines.
TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("0BSD", f"{_PERMIT}. {_AS_IS_ISC}"),
    (
        "ISC",
        f"{_PERMIT}, provided that the above copyright notice and this permission notice appear in all copies. {_AS_IS_ISC}",
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    (
        "BSD-3-Clause",
        _BSD_HEAD + _BSD_NAMES + _BSD_TAIL,
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("Rights-Reserved", "All rights reserved."),
    # the usual forms of the above with bullets in place of numbers, and with other words for the holder
    *[
        (name, text)
        for name, body in (("BSD-2-Clause", ""), ("BSD-3-Clause", _BSD_NAMES))
        for held in (_BSD_TAIL, _BSD_TAIL.replace("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"))
        for text in (_BSD_HEAD + body + held, re.sub(r"\b[123]\. ", "", _BSD_HEAD + body) + held)
    ],
]
#: Words of a canonical form by which candidates are found.
FIRST = 3
_END = "END OF TERMS AND CONDITIONS"


#: Titles as a line of their own, in cleaned text.
_TITLE = (
    r"(?:the )?(?:(?:mit|expat|mit expat|isc|0bsd|(?:(?:new|modified|revised|simplified|zero clause|[0-3] clause) )?bsd(?: (?:zero|[0-3]) clause)?"
    r"(?: (?:new|modified|revised|simplified|freebsd)(?: or (?:new|modified|revised|simplified|freebsd))?)?|apache(?: software)?|mozilla public"
    r"|gnu (?:(?:lesser|library) )?general public|gnu free documentation|artistic) licen[cs]e"
    r"(?: (?:mit|expat|isc|0bsd|bsd|gpl|lgpl|mpl|[0-3] clause|bsd [0-3] clause|(?:version |v)?[0-9](?: [0-9])?))*+|mit|isc|0bsd|bsd [0-3] clause|licen[cs]e)"
)
#: Titles, copyright lines and rights reserved before a text's first other line.
_HEAD = rf"^(?:(?: ?{_TITLE} ?| ?copyright(?:ed)? [^\n]*+| ?all rights reserved ?| ?)\n)*+"


def _clean(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation; lines stay."""
    lower = F.lower(text)
    owned = F.regexp_replace(lower, r"(?m)^[^a-z0-9\n]*(?:copyright(?:ed)?[^a-z0-9\n]*(?:[0-9]|by[^a-z\n]|c[^a-z\n])|\(c\)|©)[^\n]*$", "")
    return F.regexp_replace(owned, r"[^\p{L}\p{N}\n]+", " ")


def _canonical(clean: Column) -> Column:
    """One line of words in their usual spelling."""
    words = F.filter(F.split(clean, r"[ \n]+"), lambda w: w != "")
    spelled = F.create_map(*[lit(x) for kv in EQUIVALENT.items() for x in kv])
    return F.array_join(F.transform(words, lambda w: F.coalesce(spelled[w], w)), " ")


def canonical(text: Column) -> Column:
    return _canonical(_clean(text))


def _body(clean: Column) -> Column:
    return F.regexp_replace(clean, _HEAD, "")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def default_texts() -> list[tuple[str, str]]:
    """``TEXTS`` and the files beside this module, as they are, without their appendix, and without a place for the owner."""
    out = list(TEXTS)
    for file in sorted((f for f in files("cellweave.llm").joinpath("licence_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name):
        text, name = file.read_text(encoding="utf-8"), file.name[: -len(".txt")]
        out.append((name, text))
        out.append((name, re.sub(r"(?m)^ *Copyright \[yyyy\].*$", "", text)))
        terms, end, _ = text.partition(_END)
        if end:
            out += [(name, terms), (name, terms + end)]
    return list(dict.fromkeys(out))


def known_texts(spark: SparkSession, texts: list[tuple[str, str]] | DataFrame | None = None) -> DataFrame:
    """``license, digest, size, first``: the catalogue, with length and first words of the canonical form.

    ``texts`` is a table or list of ``license, text``, else ``default_texts``.  A text counts as it is
    and without its head, the title and copyright lines that it begins with.
    """
    if not isinstance(texts, DataFrame):
        texts = spark.createDataFrame(default_texts() if texts is None else texts, "license string, text string")
    clean = texts.select("license", _clean(col("text").cast("string")).alias("clean"))
    forms = clean.select("license", F.explode(F.array("clean", _body(col("clean")))).alias("clean"))
    forms = forms.select("license", _canonical(col("clean")).alias("form")).where("form <> ''").distinct()
    return forms.select("license", digest(col("form")).alias("digest"), F.length("form").alias("size"), F.substring_index("form", " ", FIRST).alias("first"))


def _begins(firsts: list[str]) -> str:
    """A pattern for cleaned text whose canonical form may begin with one of ``firsts``."""
    spelled: dict[str, list[str]] = {}
    for a, b in EQUIVALENT.items():
        spelled.setdefault(b.split(" ")[0], []).append(a)
    patterns = set()
    for first in firsts:
        words = []
        for word in first.split(" "):
            words.append("(?:" + "|".join(re.escape(w) for w in sorted({word, *spelled.get(word, [])})) + ")")
            if any(" " in EQUIVALENT[w] for w in spelled.get(word, [])):
                break  # one word in the text may stand for this one and the next
        patterns.add(r"[ \n]+".join(words))
    return r"^[ \n]*+(?:" + "|".join(sorted(patterns)) + r")(?:[ \n]|$)" if patterns else "$^"


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, license, notices`` for every row: the licence that the entire text is, and those that entire lines are.

    Case, punctuation, white space, copyright lines and spelling do not matter, nor does an entire
    text's head of title, copyright and rights-reserved lines; apart from that a text or line must be the licence's in full, so an excerpt or a changed licence is no match.
    ``license`` is NULL if the text as a whole is no known one; ``notices`` are the distinct licences
    of lines, in order.  ``known`` is a catalogue made by ``known_texts``; for two licences of one
    digest the first name counts.

    Only candidates are spelled out and looked up: canonical forms are at least a third as long as
    cleaned ones, and a text or line can only be known if its first words begin a known one.  NULL
    and empty texts match nothing, repeated rows match each, an empty table gives an empty result.
    """
    known = known_texts(docs.sparkSession) if known is None else known
    known = known.groupBy("digest").agg(F.min("license").alias("license"), F.first("size").alias("size"), F.first("first").alias("first"))
    most, firsts = known.agg(F.max("size"), F.collect_set("first")).first()
    begins = _begins(firsts or [])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), col(id_col).alias("id"), _clean(col(text_col).cast("string")).alias("clean")
    )
    room = 3 * (most or 0) + 2
    candidate = lambda x: (F.length(x) <= room) & x.rlike(begins)
    unit = lambda whole: lambda x: F.struct(lit(whole).alias("whole"), digest(_canonical(x)).alias("unit"))
    units = F.concat(
        F.transform(F.filter(F.split("clean", "\n"), candidate), unit(False)),
        F.transform(F.filter(F.array_distinct(F.array("clean", _body(col("clean")))), candidate), unit(True)),
    )
    marked = rows.select("row", "id", F.coalesce(units, F.array().cast("array<struct<whole:boolean,unit:string>>")).alias("units"))
    flat = marked.select("row", "id", F.explode_outer("units").alias("u")).select("row", "id", "u.whole", "u.unit")
    found = sized_join(flat, known.select(col("digest").alias("unit"), "license"), ["unit"], "left")
    return (
        found.groupBy("row", "id")
        .agg(
            F.min(F.when(col("whole"), col("license"))).alias("license"),
            F.array_sort(F.collect_set(F.when(~col("whole"), col("license")))).alias("notices"),
        )
        .drop("row")
    )
