"""Line dedup by a segment-partition edit join, DataFrame functions only.

A line is its sequence of tokens: what stands between blanks, or, where most
characters take three bytes (Han, kana, Thai ...), single characters and runs of
other letters and digits.  Two lines are linked when at most ``budget(n)``
insertions, deletions or substitutions of tokens turn one into the other, ``n``
being the number of tokens of the shorter one.  The budget follows the length,
``sqrt(n / 8)`` rounded down: none below 8 tokens, one below 32, 2 below 72, 3
below 128, 4 below 200, 10 from 800 on, 30 from 7,200 on (the band of one 64-bit
number).

Segments.  Lines with one budget ``t`` are a class; its shortest line has ``L``
tokens.  The first ``L`` tokens of each of its lines are split into ``t + 1``
segments of one width, so the index of a class needs no exact length.  Edits
can't touch all segments: the first segment with no more edits up to its end
than segments before it stands whole in the other line, moved by no more places
than there are segments before it.  So a line probes its own class, and the one
below if a line of it can be near enough, with the substrings at those places
(multi-match-aware selection of Li et al., "Pass-Join", 2011).  With the square
root, a line has about as many probes as a tenth of its tokens, and segments
grow with the line.

Verification.  A token's hash is cut to 20 bits, one code point, so that a line
is a string and Spark's own ``levenshtein`` with a limit tells most pairs apart:
two tokens may get one code point, so that its distance is never too large.  It
is the distance if the tokens of both lines have as many code points as there
are tokens; if not, ``within`` works on the whole hashes, a banded bit-parallel
edit distance: the cells of a column that lie in the band are the bits of one
number per error level, updated with a few bit operations for each token (after
Wu and Manber, 1992).

Scale.  Equal lines are one row from a map-side aggregation on.  Only hashes are
shuffled for the join of segments with probes; a line's own segments are among
its probes, so both are made at once.  Lines that share a segment of more than
``HOT`` lines are dealt into chunks of about ``CHUNK`` lines of one length, and
two chunks whose lengths allow a link are one row, which any task can compare:
each pair of lines is looked at, none becomes a row of its own.  A pair that
shares several such segments counts with the smallest one only.  The comparisons
in a group of near copies, and its links, grow with the square of its lines; the
rows do with that square divided by ``CHUNK``.  From two chunks, ``line_dedup``
takes each line's number of links and one line of its component there,
``line_links`` every link.  No candidate is dropped, so the links are exactly
all pairs within the budget, and the groups their connected components.

Result: one row for each line of each document with a token: its class (equal
lines), the number of its copies, its group, the number of its verified links,
and whether it stays: the first line of a group does ("first" by document id,
then line number, null ids last).

A class is named by a 64-bit hash of its text, a token is known by one.

Defined results: a null or empty text has no lines; repeated rows have equal
lines, the first of which can't be told apart (each stays or goes alike);
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medstar.llm.common import cut
from medstar.llm.components import components

PER_EDIT, MAX_EDITS, HOT, CHUNK, BROADCAST_IDS = 8, 30, 12, 200, 2_000_000
_ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
TOKEN = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_ALONE}]]+|\S"


def budget(n: Column) -> Column:
    """Edits allowed between lines the shorter of which has ``n`` tokens."""
    return F.least(F.lit(MAX_EDITS), F.floor(F.sqrt(n / PER_EDIT))).cast("int")


def _least(t: Column) -> Column:
    """Tokens of the shortest line with budget ``t``."""
    return (PER_EDIT * t * t).cast("int")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(line: Column) -> Column:
    blanks = "\t\r\x0b\x0c\xa0"
    odd = line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains(
        "\x0c") | line.contains("\xa0")
    plain = F.when(odd, F.translate(line, blanks, " " * len(blanks))).otherwise(line)
    words = F.split(plain, " ")
    wide = F.octet_length(line) > 2 * F.length(line)
    loose = odd | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return (F.when(wide, F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0)))
            .when(loose, F.filter(words, lambda w: w != "")).otherwise(words))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def tokens(line: Column) -> Column:
    return _hashes(_words(line))


def _code(h: Column) -> Column:
    return h.bitwiseAND(0xFFFFF)


def _coded(x: Column) -> Column:
    """The tokens as a string of one code point each."""
    digits = F.transform(x, lambda h: F.lpad(F.hex(_code(h) + 0x10000), 8, "0"))
    return F.decode(F.unhex(F.array_join(digits, "")), "UTF-32")


def _entries(x: Column, t: Column, home: Column) -> Column:
    """Keys of the substrings of ``x`` that can be whole segments of a line with
    budget ``t``; ``own``: a segment of ``x`` itself, if ``home`` is its class."""
    def of(w: Column) -> Column:
        def segment(i: Column) -> Column:
            # edits before the segment make its move, edits after it the rest
            first = i * w + 1
            return F.transform(F.sequence(first + F.greatest(-i, i - t), first + i), lambda p: F.when(
                p + w <= F.size(x) + 1, F.struct(F.xxhash64(t, i, F.slice(x, p, w)).alias("key"),
                                                 t.alias("t"), (home & (p == first)).alias("own"))))

        return F.flatten(F.transform(F.sequence(F.lit(0), t), segment))

    return _let(F.floor(_least(t) / (t + 1)).cast("int"), of)


def _probes(lines: DataFrame) -> DataFrame:
    """(id, n, t, key, own): probes of a line in its class and the one below, as
    far as a line there can be as near as that class's budget."""
    t, n, words = F.col("t"), F.col("n"), F.col("words")
    below = F.when((t > 1) & (n - (t - 1) < _least(t)), t - 1)
    # no probe reaches behind the segments by more than the budget
    x = _hashes(F.slice(words, F.lit(1), _least(t) + t))
    entries = _let(x, lambda x: F.flatten(F.transform(
        F.array_compact(F.array(t, below)), lambda c: _entries(x, c, c == t))))
    return (lines.select("id", F.explode(F.array(_words(F.col("line")))).alias("words"))
            .select("id", "words", F.size("words").alias("n"), budget(F.size("words")).alias("t"))
            .filter("t > 0").select("id", "n", F.explode(entries).alias("e"))
            .filter("e is not null").select("id", "n", "e.*"))


def within(a: Column, b: Column, k: Column) -> Column:
    """Least edits between two arrays, null if more than ``k``; ``b`` is the
    longer one, by ``k`` at most.

    Bit ``k + d`` of row ``e`` after ``j`` tokens of ``b``: its first ``j``
    tokens and the first ``j + d`` of ``a`` are at most ``e`` edits apart.
    """
    one = F.lit(1).cast("long")
    left = lambda x, n: F.call_function("shiftleft", x, n)
    right = lambda x, n: F.call_function("shiftright", x, n)

    def body(m: Column) -> Column:
        a, b, k, full = m["a"], m["b"], m["k"], left(one, 2 * m["k"] + 1) - 1

        def step(state: Column, c: Column) -> Column:
            # after this token diagonal d ends at place j + d of the shorter line
            same = F.aggregate(F.sequence(-k, k), F.lit(0).cast("long"), lambda bits, d: F.when(
                F.get(a, state["j"] + d) == c, bits.bitwiseOR(left(one, k + d))).otherwise(bits))

            def row(out: Column, e: Column, same: Column) -> Column:
                kept, less = F.get(state["r"], e).bitwiseAND(same), F.get(state["r"], e - 1)
                new = (kept.bitwiseOR(less)                      # c for another
                       .bitwiseOR(right(less, F.lit(1)))         # c is inserted
                       # a token of the shorter line is left out
                       .bitwiseOR(left(F.get(out, e - 1), F.lit(1))).bitwiseAND(full))
                return F.concat(out, F.array(F.when(e == 0, kept).otherwise(new)))

            rows = _let(same, lambda s: F.aggregate(
                F.sequence(F.lit(0), k), F.array().cast("array<bigint>"), lambda out, e: row(out, e, s)))
            dead = F.get(state["r"], k) == 0                     # more than k edits already
            return F.when(dead, state).otherwise(F.struct(rows.alias("r"), (state["j"] + 1).alias("j")))

        # before the first token: d tokens of the shorter are d edits
        start = F.struct(F.transform(F.sequence(F.lit(0), k), lambda e: left(
            left(one, e + 1) - 1, k)).alias("r"), F.lit(0).alias("j"))
        last = k + F.size(a) - F.size(b)                         # the last diagonal
        return F.aggregate(b, start, step, lambda s: F.nullif(F.array_position(F.transform(
            s["r"], lambda r: right(r, last).bitwiseAND(one)), one), F.lit(0)) - 1)

    n, m = F.size(a), F.size(b)

    def middle(ends: Column) -> Column:
        p, q = ends["p"], ends["q"]
        return F.struct(F.slice(a, p + 1, n - p - q).alias("a"), F.slice(b, p + 1, m - p - q).alias("b"),
                        k.alias("k"))

    return F.when(m - n <= k, _let(_common_ends(a, b, n, m), lambda e: _let(middle(e), body)))


def _common_ends(a: Column, b: Column, n: Column, m: Column) -> Column:
    """Lengths ``p`` and ``q`` of the common beginning and of the common end of
    what follows it, by bisection; ``n <= m`` are the lengths."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int"))

    def longest(limit: Column, same) -> Column:
        # the powers of two from the largest on, each added if it still agrees
        powers = F.reverse(F.transform(steps, lambda i: F.pow(F.lit(2.0), i).cast("int")))
        return F.aggregate(powers, F.lit(0), lambda at, w: F.when(
            (at + w <= limit) & same(at + w), at + w).otherwise(at))

    p = longest(n, lambda k: F.slice(a, F.lit(1), k) == F.slice(b, F.lit(1), k))
    return _let(p, lambda p_: F.struct(p_.alias("p"), longest(
        n - p_, lambda k: F.slice(a, n - k + 1, k) == F.slice(b, m - k + 1, k)).alias("q")))


def _each_line(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select("doc_id", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
            .filter(F.col("line").rlike(r"\S")))


def _edits(a: Column, b: Column, k: Column) -> Column:
    """Least edits between two lines ``x`` with their code points ``s``, null if
    more than ``k``; ``b`` is the longer one."""
    def same(both: Column) -> Column:
        return F.size(both) == F.size(F.array_distinct(F.transform(both, _code)))

    def of(least: Column) -> Column:
        alone = _let(F.array_distinct(F.concat(a["x"], b["x"])), same)
        return F.when(least >= 0, F.when(alone, least).otherwise(within(a["x"], b["x"], k).cast("int")))

    return _let(F.call_function("levenshtein", a["s"], b["s"], k), of)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, edits) of the pairs that are links, a < b; those of lines with a
    segment of many lines in common are left to the chunks."""
    one = texts.select(F.col("id").alias("a"), F.struct("x", "s", "own").alias("one"))
    two = texts.select(F.col("id").alias("b"), F.struct("x", "s", "probes").alias("two"))
    both = pairs.distinct().join(one, "a").join(two, "b").filter(
        ~F.arrays_overlap("one.own", "two.probes"))
    edits = _edits(F.col("one"), F.col("two"), budget(F.size("one.x")))
    return (both.select("a", "b", F.explode(F.array(edits)).alias("edits")).filter("edits is not null")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "edits"))


def _chunks(hot: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, t, n, chunk, home, lines): lines of one length that share a segment;
    ``home``: with lines whose own segment it is."""
    lines = hot.groupBy("key", "b").agg(
        F.max("own").alias("home"), F.first("n").alias("n"), F.first("t").alias("t"))
    sizes = lines.groupBy("key", "n").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    return (lines.join(sizes, ["key", "n"]).join(texts.withColumnRenamed("id", "b"), "b")
            .withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
            .groupBy("key", "t", "n", "chunk").agg(F.max("home").alias("home"), F.collect_list(
                F.struct(F.col("b").alias("id"), "home", "x", "s", "own", "probes")).alias("lines")))


def _chunk_pairs(chunks: DataFrame) -> DataFrame:
    """(i, j, cells): every two chunks of a segment whose lengths allow a link;
    ``cells``: for each line of ``j`` and each of ``i`` their edits, or null."""
    places = chunks.select("key", "t", "n", "chunk", "home")
    one = places.filter("home").select("key", "t", F.col("n").alias("ni"), F.col("chunk").alias("ci"))
    two = places.select("key", F.col("n").alias("nj"), F.col("chunk").alias("cj"))
    lines = chunks.select("key", "n", "chunk", "lines")
    pairs = (one.join(two, "key").filter("nj >= ni and nj - ni <= t")
             .join(lines.toDF("key", "ni", "ci", "i"), ["key", "ni", "ci"])
             .join(lines.toDF("key", "nj", "cj", "j"), ["key", "nj", "cj"]))
    # comparing takes long for its few bytes: dealt by number, not by size
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, "key", "ni", "ci", "nj", "cj")
    key, t, longer = F.col("key"), F.col("t"), F.col("nj") > F.col("ni")

    def cell(a: Column, b: Column) -> Column:
        # the pair counts with the smallest of the segments that both have
        first = F.array_min(F.array_intersect(a["own"], b["probes"])) == key
        # of two equally long lines each probes the other
        return F.when(a["home"] & (longer | (a["id"] < b["id"])), _let(
            _edits(a, b, t), lambda e: F.when(e.isNotNull() & first, e)))

    cells = F.transform("j", lambda b: F.transform("i", lambda a: cell(a, b)))
    ids = lambda c: F.transform(c, lambda x: x["id"]).alias(c)
    return (pairs.select("i", "j", F.explode(F.array(cells)).alias("cells"))
            .filter(F.exists("cells", lambda row: F.exists(row, lambda e: e.isNotNull())))
            .select(ids("i"), ids("j"), "cells"))


def _links_of(cells: DataFrame) -> DataFrame:
    """(a, b, edits) of every link, a < b."""
    links = F.flatten(F.transform("cells", lambda row, j: F.filter(F.transform(row, lambda e, i: F.struct(
        F.get("i", i).alias("a"), F.get("j", j).alias("b"), e.alias("edits"))), lambda e: e["edits"].isNotNull())))
    return cells.select(F.explode(links).alias("e")).select(
        F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b"), "e.edits")


def _sums_of(cells: DataFrame) -> DataFrame:
    """(id, n_links, near): the number of links of a line between two chunks,
    and one line for each component that these links make."""
    def linked(row: Column, label: Column) -> Column:
        return F.array_distinct(F.array_compact(F.transform(
            row, lambda e, i: F.when(e.isNotNull(), F.get(label, i)))))

    def merged(label: Column, row: Column) -> Column:
        return _let(linked(row, label), lambda met: F.when(F.size(met) < 2, label).otherwise(
            _let(F.array_min(met), lambda least: F.transform(
                label, lambda x: F.when(F.array_contains(met, x), least).otherwise(x)))))

    # lines of i that a line of j links get one label, the place of one of them
    start = F.transform("i", lambda _, at: at)
    labels = F.explode(F.array(F.aggregate("cells", start, merged))).alias("label")
    label = F.col("label")

    def of(id_: Column, n: Column, near: Column) -> Column:
        return F.struct(id_.alias("id"), n.cast("long").alias("n_links"), F.get("i", near).alias("near"))

    ones = F.transform("i", lambda a, i: of(a, F.size(F.filter(
        "cells", lambda row: F.get(row, i).isNotNull())), F.get(label, i)))
    twos = F.transform("cells", lambda row, j: of(F.get("j", j), F.size(F.filter(
        row, lambda e: e.isNotNull())), F.get(linked(row, label), F.lit(0))))
    return (cells.select("i", "j", "cells", labels)
            .select(F.explode(F.filter(F.concat(ones, twos), lambda e: e["n_links"] > 0)).alias("e"))
            .select("e.*"))


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The links of lines without a segment of many lines in common, and the
    compared chunks with all others; see the module's docstring."""
    each = _each_line(docs).select(F.xxhash64("line").alias("id"), "line")
    probes = cut(_probes(each.groupBy("id").agg(F.first("line").alias("line"))), "line-probes")
    index = probes.filter("own").groupBy("key").agg(
        F.min(F.struct("id", "n")).alias("one"), F.count("*").alias("lines"))
    # a segment of one line is a pair with each probe; the others follow
    hits = cut(probes.withColumnRenamed("id", "b").join(index, "key")
               .filter("lines > 1 or (one.id != b and n - one.n <= t and "
                       "(n > one.n or (n = one.n and one.id < b)))")
               .select("key", "lines", "b", "n", "t", "own", F.col("one.id").alias("a")), "line-hits")
    # every line of a shared segment probes it itself
    ids = cut(hits.select(F.col("b").alias("id")).union(
        hits.filter("lines = 1").select(F.col("a").alias("id"))).distinct(), "line-ids")
    # ids of a size that has been counted meet the lines where they are read
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    hot = hits.filter(f"lines > {HOT}")
    keys = hot.groupBy(F.col("b").alias("id")).agg(
        F.collect_set(F.when(F.col("own"), F.col("key"))).alias("own"), F.collect_set("key").alias("probes"))
    none = F.array().cast("array<bigint>")
    texts = cut(each.join(wanted, "id", "left_semi").groupBy("id").agg(F.first("line").alias("line"))
                .select("id", F.explode(F.array(tokens(F.col("line")))).alias("x"))
                .select("id", "x", _coded(F.col("x")).alias("s")).join(keys, "id", "left")
                .withColumns({c: F.coalesce(c, none) for c in ("own", "probes")}), "line-texts")
    # segments of a few lines: numbers only
    some = hits.filter(f"lines > 1 and lines <= {HOT}")
    near = (some.filter("own").select("key", F.col("b").alias("a"), F.col("n").alias("na"))
            .join(some.select("key", "t", "b", "n"), "key")
            .filter("a != b and n >= na and n - na <= t and (n > na or a < b)").select("a", "b"))
    links = cut(_verified(hits.filter("lines = 1").select("a", "b").union(near), texts), "line-links")
    if hot.isEmpty():
        return links, None
    return links, _chunk_pairs(cut(_chunks(hot, texts), "line-chunks"))


def line_links(docs: DataFrame) -> DataFrame:
    """All verified links (a, b, edits) between classes of lines; see the
    module's docstring."""
    links, cells = _found(docs)
    return links if cells is None else links.union(_links_of(cells))


def _linked(docs: DataFrame) -> DataFrame:
    """(class_id, n_links, group_id) of the classes of lines with a link."""
    links, cells = _found(docs)
    sums = links.select(F.col("a").alias("id"), F.lit(1).cast("long").alias("n_links"), F.col("b").alias("near")).union(
        links.select("b", F.lit(1).cast("long"), "a"))
    if cells is not None:
        sums = sums.union(_sums_of(cells))
    sums = cut(sums, "line-sums")
    degrees = sums.groupBy(F.col("id").alias("class_id")).agg(F.sum("n_links").alias("n_links"))
    return degrees.join(components(sums, "id", "near").select(
        F.col("node").alias("class_id"), F.col("label").alias("group_id")), "class_id")


def _order(doc_id: Column, line_no: Column) -> Column:
    return F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), line_no.alias("line_no"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, class_id, n_copies, group_id, n_links, kept)."""
    rows = cut(_each_line(docs).select("doc_id", "line_no", F.xxhash64("line").alias("class_id")),
               "line-rows")
    classes = rows.groupBy("class_id").agg(
        F.min(_order(F.col("doc_id"), F.col("line_no"))).alias("first"),
        F.count("*").alias("n_copies"))
    linked = _linked(docs)
    of = cut(classes.join(linked, "class_id", "left").select(
        "class_id", "first", "n_copies", F.coalesce("group_id", "class_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "line-classes")
    firsts = of.groupBy("group_id").agg(F.min("first").alias("group_first"))
    of = cut(of.join(firsts, "group_id").drop("first"), "line-verdicts")
    own = _order(F.col("doc_id"), F.col("line_no"))
    return rows.join(of, "class_id").select(
        "doc_id", "line_no", "class_id", "n_copies", "group_id", "n_links",
        (own == F.col("group_first")).alias("kept"))


def dedup_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts without the lines that go; blank lines stay.
    Rows of one id share their verdicts."""
    gone = (line_dedup(docs).filter("not kept").groupBy(F.col("doc_id").alias("of"))
            .agg(F.collect_set("line_no").alias("gone")))
    text = F.coalesce(F.col("text"), F.lit(""))
    left = F.filter(F.split(text, "\n"), lambda x, i: ~F.coalesce(
        F.array_contains(F.col("gone"), i), F.lit(False)))
    return docs.select("doc_id", "text").join(gone, F.col("doc_id").eqNullSafe(F.col("of")), "left").select(
        "doc_id", F.array_join(left, "\n").alias("text"))
