"""Licence scan by canonical digest lookup, DataFrame functions only.

A text is brought to a canonical form: lower case, copyright lines dropped,
equivalent spellings made one, punctuation and line breaks as blanks.  Its
digest is looked up among the digests of known licence texts and notices by a
hash join; only entire texts match.  Looked up are the whole document, each of
its lines (a notice is mostly one line of a document), and each run of
paragraphs that begins like a known text and has as many paragraphs (a licence
within a longer document).

Known texts are the files of the folder ``licences`` beside this module, each
named by its licence (``.notice``: the header that the licence asks for), with
and without the titles in ``TITLES``; one-line notices are built from ``NAMES``
and ``VERBS``.  Other tables go in as (licence, text) pairs.

A copyright line is known by what follows the word: a year or a place for one,
the sign, or a capitalised name; lines of a text's body that merely begin with
the word stay, so a text may be wrapped anywhere.

Scale: one pass over the texts; a row leaves it as 16-byte digests, and the
join is against a small table, fixed by the release (a few hundred rows).  Runs
of paragraphs are formed only where a paragraph equals the first one of a known
text, once for each number of paragraphs a known text has.

Defined results: a null text has nothing to match; lines, paragraphs and
documents that are empty in canonical form match nothing; repeated rows match
each; several licences with one canonical text match each; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings that mean the same in licence texts.
SPELLINGS = [
    ("&", " and "), ("https:", "http:"), ("licence", "license"), ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"), ("copyright owner", "copyright holder"),
    ("merchantibility", "merchantability"), ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"), ("favour", "favor"), ("organisation", "organization"),
    ("creative commons", "cc"), ("attribution-noncommercial", "by-nc"), ("version ", "v"),
]
#: Of a line in lower case: the word or the sign with a year, a place for a
#: year or the sign; a line of reserved rights.
COPYRIGHT = (r"^[ \t*#/;-]*(copyright[ :]*(\(c\)|©)|©|(copyright|\(c\))[ ,:]*([0-9]{4}|[<\[](year|yyyy)[>\]]))"
             r"|^[^\p{L}]*all rights reserved[^\p{L}]*$")
#: Of a line as it is: the word with a name; words of licence bodies aren't names.
NAMED = r"^[ \t*#/;-]*[Cc]opyright[ :]+(by )?\p{Lu}\p{Ll}"
BODY = r"^[ \t*#/;-]*[Cc]opyright[ :]+(Holder|Owner|Notice|Law|License|Licence|Act|Statement)"
PUNCTUATION = r"[^\p{L}\p{N}]+"
BLANK = r"^\s*$"
_BREAK = "\x01"                                   # between paragraphs; no letter or digit

#: Titles that stand above the texts without one of their own.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "Expat License"],
    "ISC": ["ISC License", "The ISC License"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License",
                     'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License",
                     'BSD 3-Clause "New" or "Revised" License', "Modified BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: Names as notices use them.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "MIT": ["MIT License"],
    "ISC": ["ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL v3"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "MPL 2.0"],
    "Unlicense": ["Unlicense"],
    "CC0-1.0": ["CC0 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0"],
}
VERBS = ["Licensed under", "Released under", "This work is licensed under",
         "Distributed under", "Available under", "This software is released under"]



def _canonical_line(line: str) -> str | None:
    low = line.lower()
    if regex.search(COPYRIGHT, low) or regex.search(NAMED, line) and not regex.search(BODY, line):
        return None
    for a, b in SPELLINGS:
        low = low.replace(a, b)
    return regex.sub(PUNCTUATION, " ", low).strip() or None


def paragraphs(text: str) -> list[str]:
    """Canonical paragraphs, for the known texts."""
    out = []
    for block in regex.split(r"\n(?:\s*\n)+", text):
        lines = [x for x in map(_canonical_line, block.split("\n")) if x]
        if lines:
            out.append(" ".join(lines))
    return out


def known_texts() -> list[tuple[str, str]]:
    """(licence, text) of every known text and notice."""
    out = []
    for file in sorted((Path(__file__).parent / "licences").glob("*.txt")):
        licence, text = file.name.removesuffix(".txt").removesuffix(".notice"), file.read_text()
        out.append((licence, text))
        if not file.name.endswith(".notice.txt"):
            out += [(licence, f"{title}\n\n{text}") for title in TITLES.get(licence, [])]
    return out + [(k, f"{verb} {the}{name}") for k, names in NAMES.items()
                  for name in names for verb in VERBS for the in ("", "the ")]


def _md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def known_digests(known: list[tuple[str, str]]) -> list[tuple[str, str, int, str]]:
    """(licence, digest, paragraphs, digest of the first one)."""
    out = set()
    for licence, text in known:
        if parts := paragraphs(text):
            out.add((licence, _md5(" ".join(parts)), len(parts), _md5(parts[0])))
    return sorted(out)


def _mark(line: Column) -> Column:
    """The canonical line, empty if it doesn't count, a break if it is blank."""
    low = F.lower(line)
    plain = low
    for a, b in SPELLINGS:
        plain = F.replace(plain, F.lit(a), F.lit(b))
    copyright = low.rlike(COPYRIGHT) | line.rlike(NAMED) & ~line.rlike(BODY)
    return (F.when(line.rlike(BLANK), F.lit(_BREAK)).when(copyright, F.lit(""))
            .otherwise(F.trim(F.regexp_replace(plain, PUNCTUATION, " "))))


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _unit(scope: str, place: Column, digest: Column) -> Column:
    return F.struct(F.lit(scope).alias("scope"), place.cast("int").alias("place"),
                    digest.alias("digest"))


def licence_hits(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, scope, place, licence): ``scope`` is ``document`` (place 0),
    ``line`` (the line's number from 1) or ``paragraphs`` (a part of a
    document; the number of its first paragraph, from 1)."""
    digests = known_digests(known_texts() if known is None else known)
    table = docs.sparkSession.createDataFrame(
        [d[:2] for d in digests], "licence string, known string")
    heads: dict[str, set[int]] = {}
    for _, _, n, first in digests:
        heads.setdefault(first, set()).add(n)
    numbers = F.array(*[F.lit(n) for n in sorted({n for x in heads.values() for n in x})] or
                      [F.lit(1)])

    marks = F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), _mark)
    blocks = lambda x: F.filter(F.transform(
        F.split(F.array_join(x, "\n"), _BREAK),
        lambda p: F.trim(F.regexp_replace(p, r"\n+", " "))), lambda p: p != "")

    def runs(p: Column) -> Column:
        # places whose paragraph is the first one of a known text
        starts = F.filter(F.transform(p, lambda y, i: F.when(
            _digest(y).isin(sorted(heads)), i)), lambda i: i.isNotNull())
        return F.flatten(F.transform(starts, lambda i: F.transform(
            F.filter(numbers, lambda n: (i + n <= F.size(p)) & (n < F.size(p))),
            lambda n: _unit("paragraphs", i + 1, _digest(F.array_join(F.slice(p, i + 1, n), " "))))))

    def units(x: Column) -> Column:
        lines = F.filter(F.transform(x, lambda y, i: F.when(
            (y != "") & (y != _BREAK), _unit("line", i + 1, _digest(y)))), lambda u: u.isNotNull())
        return F.element_at(F.transform(F.array(blocks(x)), lambda p: F.concat(
            F.array(_unit("document", F.lit(0), F.when(F.size(p) > 0, _digest(
                F.array_join(p, " "))))), lines, runs(p))), 1)

    rows = docs.select("doc_id", F.explode(F.element_at(F.transform(F.array(marks), units), 1)).alias("u"))
    return (rows.select("doc_id", "u.*").join(table, F.col("digest") == F.col("known"))
            .select("doc_id", "scope", "place", "licence"))


def _sql() -> str:
    """The same in SQL; it shares the digests of the known texts only."""
    line = "lower(x)"
    for a, b in SPELLINGS:
        line = f"replace({line}, '{a}', '{b}')"
    values = ", ".join(f"('{k}', '{d}', {n})" for k, d, n, _ in known_digests(known_texts()))
    return rf"""
WITH k(licence, digest, n) AS (VALUES {values}),
l AS (SELECT doc_id, row_id, i AS line_no, ls[i] AS x FROM (
        SELECT doc_id, row_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (
          SELECT doc_id, row_number() OVER () AS row_id,
                 string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
b AS (SELECT *, regexp_matches(x, '{BLANK}') AS blank,
             sum(CAST(regexp_matches(x, '{BLANK}') AS INTEGER))
               OVER (PARTITION BY row_id ORDER BY line_no) AS block FROM l),
c AS (SELECT doc_id, row_id, line_no, block,
             trim(regexp_replace({line}, '{PUNCTUATION}', ' ', 'g')) AS canon
      FROM b WHERE NOT blank AND NOT regexp_matches(lower(x), '{COPYRIGHT}')
        AND NOT (regexp_matches(x, '{NAMED}') AND NOT regexp_matches(x, '{BODY}'))),
p AS (SELECT doc_id, row_id, string_agg(canon, ' ' ORDER BY line_no) AS canon,
             row_number() OVER (PARTITION BY row_id ORDER BY block) AS i
      FROM c WHERE canon <> '' GROUP BY doc_id, row_id, block),
d AS (SELECT doc_id, row_id, list(canon ORDER BY i) AS ps FROM p GROUP BY doc_id, row_id),
r AS (SELECT doc_id, ps, i, unnest([x for x in (SELECT list(DISTINCT n) FROM k)
                                    if i + x - 1 <= len(ps) and x < len(ps)]) AS n
      FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM d)),
u AS (SELECT doc_id, 'line' AS scope, line_no AS place, md5(canon) AS digest
      FROM c WHERE canon <> ''
      UNION ALL
      SELECT doc_id, 'document', 0, md5(array_to_string(ps, ' ')) FROM d
      UNION ALL
      SELECT doc_id, 'paragraphs', i, md5(array_to_string(ps[i:i + n - 1], ' ')) FROM r)
SELECT doc_id, scope, CAST(place AS INTEGER) AS place, licence
FROM u JOIN (SELECT DISTINCT licence, digest FROM k) AS k USING (digest)
"""


LICENCE_SQL = _sql()
