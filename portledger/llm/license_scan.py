"""License scan by canonical digests, in DataFrame operations only.

Every entire text unit of a document (the whole text, each paragraph, each line) is brought into a
canonical form: lower case, without copyright lines, punctuation as blanks, equivalent spellings
made one. The digest of that form is looked up in the digests of known license texts and notices by a hash
join. Lines without a letter or digit part paragraphs, so texts inside comment frames count too. A known
text of several paragraphs is found inside a document as a run of paragraphs with its digests, in its order.

The known side is a table ``(license, text)``: the notices of this module and the license texts and file headers in
``licenses/`` beside it, or a caller's own. Documents are never shuffled; only found units are grouped.

Result: one row per unit found, ``doc_id, unit, position, license, digest``; ``position`` counts the
units of a kind from 0. A unit that is the whole text is reported as ``text`` only, a paragraph of
one line as ``line`` only. A run of paragraphs is a ``passage``, its position is that of its first paragraph and its digest that of the
known text; runs that are all of a document are its ``text``. Null or empty text has no units. A null ``doc_id`` stays null. Repeated
rows are scanned each. Other columns are not looked at.
"""

import re
from importlib import resources

from pyspark.sql import functions as F

from portledger.llm.common import as_text, small_side
from portledger.session import checkpoint_root

# License identifiers and the names they go by.
NAMES = {
    "MIT": ["MIT License", "Expat License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "0BSD": ["Zero-Clause BSD License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL, version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL, version 3", "GPLv3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "MPL 2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons Zero 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"],
}

# Notices that name a license.
NOTICES = [
    "{}",
    "Licensed under {}.",
    "Licensed under the {}.",
    "Released under the {}.",
    "Released under {}.",
    "Distributed under the {}.",
    "This work is licensed under {}.",
    "This work is licensed under the {}.",
    "This project is licensed under the {}.",
    "This software is released under the {}.",
    "SPDX-License-Identifier: {}",
    "License: {}",
]

# License texts.
DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
PERMISSION = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
NO_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEXTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions: The above copyright notice and this permission notice shall be included in all copies "
    "or substantial portions of the Software. " + DISCLAIMER,
    "ISC": PERMISSION + ", provided that the above copyright notice and this permission notice appear in all "
    "copies. " + NO_WARRANTY,
    "0BSD": PERMISSION + ". " + NO_WARRANTY,
}
TITLES = {"MIT": "MIT License", "ISC": "ISC License", "0BSD": "Zero-Clause BSD License"}

# Spellings that count as equal, as words between blanks.
SPELLINGS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sub license": "sublicense",
    "sublicence": "sublicense",
    "non commercial": "noncommercial",
    "non infringement": "noninfringement",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "merchantibility": "merchantability",
    "whilst": "while",
    "wilful": "willful",
    "favour": "favor",
    "organisation": "organization",
    "v 2": "version 2",
    "v 3": "version 3",
    "v2": "version 2",
    "v3": "version 3",
}
COPYRIGHT_LINE = r"(^|\n)[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|:|<year>|\[year\]|[0-9]{4})|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
# Between paragraphs: a line without a letter or digit. It becomes a line of the sign PART alone.
SEPARATOR = r"\n[^\p{L}\p{N}\n]*\n"
PART = "\u0001"
PUNCTUATION = r"[^\p{L}\p{N}\n\x01]+"
# Sentences that begin a paragraph of the texts above, and list items, which follow with or without a blank line.
OPENING = r"(?<=[.]) (?=The above|THE SOFTWARE)"
ITEM = r"\n\s*\n(?=\s*(?:[0-9*]+[.)]? )\S)"
CLOSING = "END OF TERMS AND CONDITIONS"


def bodies(text):
    """A text column in lower case, without copyright lines and punctuation; its lines and parted paragraphs stay."""
    out = F.regexp_replace(F.translate(text, PART, "\u0002"), SEPARATOR, f"\n{PART}\n")
    return F.regexp_replace(F.regexp_replace(F.lower(out), COPYRIGHT_LINE, "$1"), PUNCTUATION, " ")


def spelled(body):
    """Canonical form of a line, paragraph or text out of ``bodies``; empty if nothing is left."""
    out = F.concat(F.lit(" "), F.regexp_replace(body, r"[ \n\x01]+", " "), F.lit(" "))
    for old, new in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(out)


def canonical(text):
    """Canonical form of a text column; empty if nothing is left."""
    return spelled(bodies(text))


def layouts(text):
    """A text and the ways it is also set: without what follows its terms, list items without blank lines."""
    cut = text.split(CLOSING)[0]
    both = [text, cut, cut + CLOSING] if CLOSING in text else [text]
    return [*both, *(re.sub(ITEM, "\n", t) for t in both)]


def known_texts():
    """``(license, text)`` of the notices, and of the license texts and headers with their layouts."""
    rows = [(i, n.format(name)) for i, names in NAMES.items() for name in [*names, i] for n in NOTICES]
    texts = [(i, t) for i, t in TEXTS.items()] + [(i, re.sub(OPENING, "\n\n", t)) for i, t in TEXTS.items()]
    texts += [(i, f"{TITLES[i]}\n\n{t}") for i, t in texts if i in TITLES]
    folder = resources.files("portledger.llm") / "licenses"
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    texts += [(f.name.removesuffix(".txt").split("__")[0], f.read_text("utf-8")) for f in files]
    return list(dict.fromkeys(rows + [(i, t) for i, text in texts for t in layouts(text)]))


def known_digests(spark, texts=None):
    """``(digest, license, whole, part, parts)`` of known texts.

    ``part`` is null where ``digest`` is that of the entire text; else it is the digest of the part-th of its ``parts`` paragraphs, from 0, if
    it has several, and ``whole`` the digest of the text. Of several licenses with one canonical text the first by name counts.
    ``texts`` is a list or a DataFrame ``(license, text)``.
    """
    texts = known_texts() if texts is None else texts
    df = spark.createDataFrame(texts, "license string, text string") if isinstance(texts, list) else texts
    df = df.select("license", bodies(F.col("text")).alias("body"))
    df = df.select("license", F.sha2(spelled(F.col("body")), 256).alias("whole"), paragraphs("body").alias("of"))
    df = df.withColumn("forms", F.transform("of", lambda p: F.sha2(spelled(p["body"]), 256)))
    df = df.groupBy("whole", "forms").agg(F.min("license").alias("license")).where("size(forms) > 0")
    entire = df.groupBy(F.col("whole").alias("digest")).agg(F.min("license").alias("license"))
    entire = entire.select("digest", "license", F.col("digest").alias("whole"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("parts"))
    several = df.where("size(forms) > 1")
    several = several.select("license", "whole", F.size("forms").alias("parts"), F.posexplode("forms").alias("part", "digest"))
    return entire.unionByName(several)


def paragraphs(body):
    """Paragraphs of a body that hold something: ``(position, body, several)``, in order; ``several`` lines or one."""
    parts = F.transform(
        F.split(body, f"\n{PART}\n"),
        lambda x, i: F.struct(i.cast("bigint").alias("position"), x.alias("body"), x.contains("\n").alias("several")),
    )
    return F.filter(parts, lambda p: p["body"].rlike(r"[^ \n\x01]"))


def units(docs):
    """``(doc_id, text_key, n, unit, position, seq, body)`` of all whole texts, paragraphs and lines with something in them.

    ``n`` counts the text's paragraphs and ``seq`` is a paragraph's place among them. A paragraph of one line, or that is
    the whole text, has the unit ``part``: it counts for passages only.
    """
    df = docs.select("doc_id", as_text(docs).alias("_t")).where("_t != ''")
    df = df.select("doc_id", F.xxhash64("_t").alias("text_key"), bodies(F.col("_t")).alias("_b"))
    df = df.withColumn("_p", paragraphs("_b"))

    def row(unit, position, seq, body):
        return F.struct(unit.alias("unit"), position.alias("position"), seq.cast("int").alias("seq"), body.alias("body"))

    none = F.lit(None)
    zero = F.lit(0).cast("bigint")
    whole = F.filter(F.array(row(F.lit("text"), zero, none, F.col("_b"))), lambda u: F.size("_p") > 0)
    own = lambda p: p["several"] & (p["body"] != F.col("_b"))
    parts = F.transform("_p", lambda p, i: row(F.when(own(p), "paragraph").otherwise("part"), p["position"], i, p["body"]))
    lines = F.transform(F.split("_b", "\n"), lambda x, i: row(F.lit("line"), i.cast("bigint"), none, x))
    lines = F.filter(lines, lambda u: u["body"].rlike(r"[^ \x01]") & F.col("_b").contains("\n"))
    return df.select("doc_id", "text_key", F.size("_p").alias("n"), F.inline(F.concat(whole, parts, lines)))


def license_units(docs, known=None):
    """The units of ``docs`` whose canonical digest is known, and the runs of paragraphs that are a known text."""
    checkpoint_root(docs.sparkSession)
    known = known_digests(docs.sparkSession) if known is None else known
    # Never null, or the join's test for null would compute each digest twice.
    digest = F.coalesce(F.sha2(spelled(F.col("body")), 256), F.lit(""))
    forms = units(docs).withColumn("digest", digest).drop("body")
    fits = F.when(F.col("part").isNull(), F.col("unit") != "part").otherwise(F.col("seq").isNotNull() & (F.col("n") > F.col("parts")))
    found = forms.join(small_side(known.checkpoint()), "digest").where(fits).checkpoint()
    columns = ["doc_id", "unit", "position", "license", "digest"]
    runs = found.where("part is not null").withColumn("first", F.col("seq") - F.col("part"))
    runs = runs.groupBy("doc_id", "text_key", "whole", "parts", "first", "license", "part").agg(
        F.count("*").alias("copies"), F.min("position").alias("position"))
    runs = runs.groupBy("doc_id", "text_key", "whole", "parts", "first", "license").agg(
        F.count("*").alias("n"), F.min("copies").alias("copies"), F.min("position").alias("position"))
    # One row for each repeated row of the table, and for each layout of a text only one.
    runs = runs.where("n = parts").groupBy("doc_id", "text_key", "whole", "position").agg(
        F.min("license").alias("license"), F.min("copies").alias("copies"))
    runs = runs.select("doc_id", "position", "license", F.col("whole").alias("digest"), F.explode(F.expr("sequence(1, copies)")))
    return found.where("part is null").select(columns).unionByName(runs.withColumn("unit", F.lit("passage")).select(columns))


def op10_license_scan(spark, sf_dir):
    return license_units(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_bodies(text):
    line = COPYRIGHT_LINE.replace("'", "''")
    out = f"regexp_replace(translate({text}, chr(1), chr(2)), '{SEPARATOR}', chr(10) || chr(1) || chr(10), 'g')"
    return f"regexp_replace(regexp_replace(lower({out}), '{line}', '\\1', 'g'), '{PUNCTUATION}', ' ', 'g')"


def _sql_digest(body):
    """The digest of the canonical form in SQL."""
    out = f"' ' || regexp_replace({body}, '[ \\n\\x01]+', ' ', 'g') || ' '"
    for old, new in SPELLINGS.items():
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"sha256(trim({out}))"


def oracle():
    values = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in known_texts())
    split = "string_split({}, chr(10) || chr(1) || chr(10))"
    some = "regexp_matches({}, '[^ \\n\\x01]')"
    return f"""
WITH known_text(license, body) AS (VALUES {values}),
kb AS (SELECT license, {_sql_bodies("body")} AS body FROM known_text),
kd AS (SELECT license, body, {_sql_digest("body")} AS whole FROM kb WHERE {some.format("body")}),
kp AS (
  SELECT license, whole, list_transform(list_filter({split.format("body")}, lambda x: {some.format("x")}),
         lambda x: {_sql_digest("x")}) AS forms FROM kd),
entire AS (SELECT whole AS digest, min(license) AS license FROM kd GROUP BY 1),
several AS (SELECT whole, forms, min(license) AS license FROM kp WHERE len(forms) > 1 GROUP BY 1, 2),
parts AS (
  SELECT whole, license, len(forms) AS parts, unnest(forms) AS digest, unnest(range(0, len(forms))) AS part FROM several),
t AS (
  SELECT row_number() OVER () AS r, doc_id, {_sql_bodies("text")} AS body FROM documents WHERE coalesce(text, '') <> ''),
p0 AS (SELECT r, doc_id, body AS whole_body, unnest({split.format("body")}) AS body,
       unnest(range(0, len({split.format("body")}))) AS position FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY position) - 1 AS seq, count(*) OVER (PARTITION BY r) AS n
      FROM p0 WHERE {some.format("body")}),
l AS (SELECT r, doc_id, unnest(string_split(body, chr(10))) AS body,
      unnest(range(0, len(string_split(body, chr(10))))) AS position FROM t WHERE contains(body, chr(10))),
u AS (
  SELECT doc_id, 'text' AS unit, 0 AS position, body FROM t WHERE {some.format("body")}
  UNION ALL SELECT doc_id, 'line', position, body FROM l WHERE {some.format("body")}
  UNION ALL SELECT doc_id, 'paragraph', position, body FROM p WHERE contains(body, chr(10)) AND body <> whole_body),
runs AS (
  SELECT r, any_value(doc_id) AS doc_id, whole, min(position) AS position, min(license) AS license
  FROM (SELECT r, doc_id, n, seq, position, {_sql_digest("body")} AS digest FROM p) q JOIN parts USING (digest)
  WHERE n > parts.parts GROUP BY r, whole, parts.parts, seq - part, license HAVING count(*) = parts.parts)
SELECT doc_id, unit, position::BIGINT AS position, license, digest
FROM (SELECT doc_id, unit, position, {_sql_digest("body")} AS digest FROM u) f JOIN entire USING (digest)
UNION ALL
SELECT any_value(doc_id), 'passage', position::BIGINT, min(license), whole FROM runs GROUP BY r, whole, position
"""
