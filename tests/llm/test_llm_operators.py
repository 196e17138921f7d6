"""The operators against brute force, exact round trips and held-out accuracy."""

import random
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import regex
from pyspark.sql import functions as F

from medstar.llm import (decontaminate, kd_shards, language_centroids, licence_digests,
                         line_edit_join, line_frequency, mixing, order_minhash, queries, textvec,
                         token_orc, toxicity_zstd)
from medstar.llm.common import held_out, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


def frame(spark, texts, **columns):
    rows = [(i, t, *[columns[c][i] for c in columns]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + "".join(
        f", {c} string" for c in columns))


def vocabulary(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(rng.randint(2, 8)))
            for _ in range(n)]


# ---------------------------------------------------------------- 1 mixing

@pytest.mark.parametrize("weights", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2},
                                     {str(i): 1 / (i + 1) for i in range(40)}])
def test_pfair_deviation(weights):
    share = mixing.shares(weights, 512)
    period = sum(share.values())
    order = mixing.schedule(share)
    assert len(order) == period
    done = Counter()
    for t, k in enumerate(order * 2, 1):
        done[k] += 1
        for s, n in share.items():
            assert abs(done[s] - n * t / period) < 1


def test_mix_whole_and_on_target(spark, docs):
    got = mixing.mix(docs, block_bytes=512, temperature=0.5).toPandas()
    n = docs.count()
    assert len(got[got.epoch == 0]) == n
    assert not got.duplicated(["doc_id", "epoch"]).any()
    # starts of an epoch are gapless within a source
    for _, g in got[got.epoch == 0].groupby("source"):
        g = g.sort_values("start")
        assert (g["start"].to_numpy() == np.r_[0, g["size"].cumsum()[:-1]]).all()
    # bytes follow the weights up to a block and a document at any place of the mix
    sizes = got[got.epoch == 0].groupby("source")["size"].sum()
    share = mixing.shares((sizes ** 0.5).to_dict(), mixing.PERIOD)
    period, most = sum(share.values()), got["size"].max()
    for slot in (100, 300, got["slot"].max()):
        done = got[got.slot < slot].groupby("source")["size"].sum()
        for s, w in share.items():
            assert abs(done.get(s, 0) - w / period * slot * 512) <= 2 * 512 + 2 * most
    first = mixing.mix(docs, block_bytes=512, until="first").toPandas()
    assert (first.epoch == 0).all() and len(first) < len(got)


def test_mix_deviates_less_than_a_block_from_unrounded_weights(spark):
    # rows of one block each: 4000 of one source, one of the other
    d = frame(spark, ["x" * 63] * 4001, source=["a"] * 4000 + ["b"])
    for w in (1 / 2000, 0.3007):
        got = mixing.mix(d, {"a": 1 - w, "b": w}, block_bytes=64).toPandas().sort_values("slot")
        assert got["slot"].tolist() == list(range(len(got))) and len(got) >= 4000
        done = (got["source"] == "b").cumsum().to_numpy()
        assert (np.abs(done - w * np.arange(1, len(got) + 1)) < 1).all()
    # a third of the bytes, 19 equal sources, and one of a block: 30 GB
    sizes = [{"__source": str(i), "bytes": n} for i, n in
             enumerate([10 * 10 ** 9] + [20 * 10 ** 9 // 19] * 19 + [64 << 10])]
    plan = mixing._plan(sizes, None, 0.8, 64 << 10, mixing.PERIOD, "all")
    weights = np.array([r["bytes"] ** 0.8 for r in sizes])
    weights /= weights.sum()
    for i, r in enumerate(sizes):
        done = np.cumsum(plan["order"] == plan["names"].index(r["__source"]))
        assert np.abs(done - weights[i] * np.arange(1, len(done) + 1)).max() < 1


def slow_mix(sizes, weights, block):
    """Source of each slot by the definition, with exact fractions, as long as
    every source takes to be used whole."""
    from fractions import Fraction

    total = sum(map(Fraction, weights.values()))
    w = {k: Fraction(x) / total for k, x in weights.items()}
    done, order = Counter(), []
    blocks = {k: -(-n // block) for k, n in sizes.items()}
    names = sorted(w, key=lambda k: (k is None, str(k)))
    while any(done[k] < blocks[k] for k in names):
        t = len(order)
        ready = [(-(-(done[k] + 1) // w[k]), i, k) for i, k in enumerate(names) if done[k] // w[k] <= t]
        order.append(min(ready)[2])
        done[order[-1]] += 1
    return order, blocks


def test_mix_places_documents_like_a_slow_scheduler(spark):
    rng = random.Random(4)
    rows = [(None, "y" * 63, "a")] * 20                        # repeated rows without an id
    rows += [(None, f"{i:063d}", "a") for i in range(50)]      # null ids, texts of one size
    rows += [(7, f"{i:063d}", "b") for i in range(30)]         # equal ids
    rows += [(i, "z" * rng.randint(0, 400), rng.choice(["c", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    weights = {"a": 0.25, "b": 0.5, "c": 0.125, None: 0.125}
    got = mixing.mix(df, weights, block_bytes=64).toPandas()
    got["source"] = got["source"].where(got["source"].notna(), None)
    sizes = Counter()
    for _, t, k in rows:
        sizes[k] += len(t) + 1
    order, blocks = slow_mix(sizes, weights, 64)
    place = defaultdict(dict)                                  # source -> how manieth block -> slot
    for slot, k in enumerate(order):
        place[k][len(place[k])] = slot
    for r in got.itertuples():
        assert r.block == r.start // 64
        assert r.slot == place[r.source][r.epoch * blocks[r.source] + r.block]
    first = got[got.epoch == 0]
    assert sorted(map(str, zip(first["size"], first["source"]))) == sorted(
        str((len(t) + 1, k)) for _, t, k in rows)
    for _, g in first.groupby("source", dropna=False):         # no start is taken twice
        g = g.sort_values("start")
        assert (g["start"].to_numpy() == np.r_[0, g["size"].cumsum()[:-1]]).all()
    # rows of one block: every slot of a and b holds exactly one, deviation below a block
    for k in ("a", "b"):
        assert got[got["source"] == k]["slot"].is_unique
        done = np.cumsum([x == k for x in order])
        assert np.abs(done - weights[k] * np.arange(1, len(order) + 1)).max() < 1


def test_the_drivers_slots_are_bounded(monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 1000)
    for scale in (10 ** 6, 10 ** 12, 10 ** 15):
        sizes = [{"__source": str(i), "bytes": scale // (i + 1)} for i in range(20)]
        plan = mixing._plan(sizes, None, 0.8, None, mixing.PERIOD, "all")
        assert len(plan["order"]) <= 1000 + 20 * 20 and plan["block_bytes"] >= mixing.BLOCK_BYTES


def test_mixed_documents_are_ordered(spark, docs):
    got = mixing.mixed_documents(docs, block_bytes=4096)
    assert got.columns == docs.columns
    a = Counter(r["doc_id"] for r in got.collect())
    b = Counter(mixing.mix(docs, block_bytes=4096).toPandas()["doc_id"])
    assert a == b


# -------------------------------------------------------------- 2 sharding

def check_shards(got, texts, shards, tolerance):
    assert len(got) == len(texts)
    for r in got.itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    sums = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert sums.max() - sums.min() <= tolerance
    return got


def test_shards_of_the_table(docs, texts):
    got = check_shards(kd_shards.shard_table(docs, 16).toPandas(), dict(texts), 16,
                       max(len((t or "").encode()) for _, t in texts))
    assert got.groupby(["text_crc32", "size"])["shard"].nunique().max() == 1


def test_shards_with_a_group_larger_than_a_shard(spark):
    texts = ["same text " * 20] * 300 + [f"text {i} " * (i % 30) for i in range(600)]
    got = check_shards(kd_shards.shard_table(frame(spark, texts), 16, dims=()).toPandas(),
                       dict(enumerate(texts)), 16, 14_000)
    assert got[got.doc_id < 300]["shard"].nunique() > 1
    assert kd_shards.shard_table(frame(spark, texts), target_bytes=20_000, dims=()).agg(
        F.countDistinct("shard")).first()[0] >= 5


def test_shards_of_rows_without_an_id(spark):
    rows = [(None, "same text " * 20, "a")] * 300
    rows += [(None, f"text {i} " * (i % 30), "b") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = kd_shards.shard_table(df, 16).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 16 and sums.max() - sums.min() <= 14_000
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    placed = kd_shards.sharded_documents(df, 16)
    assert placed.count() == 900 and placed.columns == [*df.columns, "shard"]
    sums = placed.groupBy("shard").agg(F.sum(F.length("text") + 1).alias("n")).toPandas()["n"]
    assert len(sums) == 16 and sums.max() < 1.5 * sums.min()


def test_text_dimensions_count_by_rank(spark):
    hosts = [None, "https://a.org", "https://a.org/x", "https://b.org", "", "é"]
    df = frame(spark, [f"t{i}" for i in range(6)], source=hosts)
    got = {r["id"]: r["x1"] for r in kd_shards._rows(df, "doc_id", "text", ["source"]).collect()}
    order = sorted({h for h in hosts if h is not None}, key=lambda h: h.encode())
    assert [got[i] for i in range(6)] == [0.0 if h is None else order.index(h) + 1.0 for h in hosts]


def brute_tree(points, shards, share, width):
    """The k-d tree by sorting: {(key, part): shard}."""
    out = {}

    def split(node, light, heavy, first, n):
        if n == 1:
            out.update({p[:2]: first for p in light} | dict.fromkeys(heavy, first))
            return
        half, total = n // 2, sum(p[2] for p in light) + sum(heavy.values())
        room = {0: total * half / n, 1: total * (n - half) / n}
        sides = {0: {}, 1: {}}
        for k, w in sorted(heavy.items(), key=lambda x: (-x[1], x[0])):
            side = 0 if room[0] >= room[1] else 1
            room[side] -= w
            sides[side][k] = w
        low = []
        if light:
            spread = [(max(p[3 + i] for p in light) >> kd_shards.HASH_BITS)
                      - (min(p[3 + i] for p in light) >> kd_shards.HASH_BITS) for i in range(width)]
            wide = spread.index(max(spread))
            goal = min(max(room[0], 0), sum(p[2] for p in light))
            below = 0
            for p in sorted(light, key=lambda p: p[3 + wide]):
                if below + p[2] >= goal:                       # the cut lies within this point
                    low += [p] if below + p[2] - goal <= goal - below else []
                    break
                below += p[2]
                low.append(p)
        names = {p[:2] for p in low}
        split(2 * node + 1, low, sides[0], first, half)
        split(2 * node + 2, [p for p in light if p[:2] not in names], sides[1], first + half, n - half)

    split(0, [p for p in points if p[2] <= share / kd_shards.HEAVY],
          {p[:2]: p[2] for p in points if p[2] > share / kd_shards.HEAVY}, 0, shards)
    return out


@pytest.mark.parametrize("shards", [3, 8])
def test_the_tree_is_the_brute_force_one(spark, docs, shards):
    rows = kd_shards._rows(docs, "doc_id", "text", ["lang", "source"])
    share = rows.agg(F.sum("size")).first()[0] / shards
    points = kd_shards._points(kd_shards._parted(rows, share), 3)
    found = {(bytes(r["key"]), r["part"]): r["shard"] for r in
             kd_shards.tree(points, shards, share).collect()}
    names = ["key", "part", "w", "k0", "k1", "k2"]
    slow = brute_tree([(bytes(r["key"]), *[r[c] for c in names[1:]]) for r in points.collect()],
                      shards, share, 3)
    # medians are exact up to a thousandth of a shard
    sizes = {(bytes(r["key"]), r["part"]): r["w"] for r in points.collect()}
    moved = sum(sizes[k] for k in slow if slow[k] != found[k])
    assert found.keys() == slow.keys() and moved <= 0.02 * sum(sizes.values())


# --------------------------------------------------------------- 3 quality

def test_quality_equals_sql(spark, docs):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    a = line_frequency.quality(docs).toPandas()
    b = con.sql(line_frequency.QUALITY_SQL).df()
    cols = sorted(a.columns)
    pd.testing.assert_frame_equal(a[cols].sort_values("doc_id", ignore_index=True),
                                  b[cols].sort_values("doc_id", ignore_index=True),
                                  check_dtype=False)


def test_frequent_lines_deplete(spark):
    v = vocabulary(1, 400)
    rng = random.Random(2)
    line = " ".join(v[:40])
    texts = [line + "\n" + " ".join(rng.choices(v, k=20)) for _ in range(6)]
    texts += [line + "\n" + " ".join(rng.choices(v, k=120)) for _ in range(2)]
    texts += [" ".join(v[100:200])] * 9                     # copies are documents
    texts += [" ".join(v[200:300])] * 5
    d = frame(spark, texts, source=["h"] * len(texts))
    got = line_frequency.quality(d, max_docs=5).toPandas().sort_values("doc_id")
    assert got["kept"].tolist() == [False] * 6 + [True] * 2 + [False] * 9 + [True] * 5
    assert got["lost_words"].tolist() == [40] * 8 + [100] * 9 + [0] * 5
    clean = {r["doc_id"]: r["text"] for r in line_frequency.cleaned(d, max_docs=5).collect()}
    assert sorted(clean) == [6, 7, *range(17, 22)] and clean[6] == texts[6].split("\n")[1]
    # the same documents on hosts of their own are no boilerplate
    apart = frame(spark, texts, source=[str(i) for i in range(len(texts))])
    assert line_frequency.quality(apart, max_docs=5).filter("lost_words > 0").count() == 0
    # 200 documents of one host that hold one line, copies of each other
    many = frame(spark, [" ".join(v[:60])] * 200, source=["h"] * 200)
    assert line_frequency.quality(many).filter("kept").count() == 0


def test_repeated_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (0, 1, 2, 3, 4, 7, 12, 60)]
    w = line_frequency.words_of(F.col("text"))

    def brute(t):
        ws = t.split()
        tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        n = Counter(tri)
        return len({i + k for i, x in enumerate(tri) if n[x] > 1 for k in range(3)})

    got = frame(spark, texts).select("text", line_frequency.repeated_words(w).alias("n"))
    for r in got.collect():
        assert r["n"] == brute(r["text"])


# ---------------------------------------------------------------- 4 tokens

def test_tokens_equal_the_tokenizer(spark, docs, texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["Don't STOP'S we'Ll 've'x", "a_b__c!!,'s  x\x1cy\x85z²¾ ªº İI ẞ", "ΑΣ σ", "日本 語x",
           "<|endoftext|> x", "é Å", "123 4.5 $&é…“q”", "\U0001F600!"]
    rng = random.Random(8)
    odd += ["".join(chr(rng.choice([*range(9, 600), 0x2019, 0x20ac, 0x2028])) for _ in range(60))
            for _ in range(150)]
    n = max(i for i, _ in texts) + 1
    d = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(n + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = token_orc.token_table(d, path, path=f"{tmp_path}/t").toPandas().sort_values("doc_id")
    tok, start = Tokenizer.from_file(path), 0
    for (i, text), r in zip([*texts, *((n + i, t) for i, t in enumerate(odd))], got.itertuples()):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (
            i, start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
    one = token_orc.read_tokens(spark, f"{tmp_path}/t", [5])
    assert one.count() == sum(i == 5 for i, _ in texts)
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or \
        "doc_id" in one._jdf.queryExecution().executedPlan().toString()


# ----------------------------------------------------------------- 5 lines

def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(ws, n, rng):
    ws = list(ws)
    for _ in range(n):
        i, what = rng.randrange(len(ws) + 1), rng.randrange(3)
        ws[i:i + (what != 1)] = [rng.choice(["xx", "yé", "7"])] if what else []
    return ws


def budget_of(n):
    return min(30, int((n / 8) ** 0.5))


def groups_of(nodes, pairs):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in pairs:
        root[find(x)] = find(y)
    out = defaultdict(set)
    for x in nodes:
        out[find(x)].add(x)
    return {frozenset(g) for g in out.values()}


def check_lines(spark, lines):
    """The links are exactly all pairs within the budget."""
    lines = [x for x in lines if x.strip()]
    key = {r["h"]: r["line"] for r in spark.createDataFrame([(x,) for x in lines], "line string")
           .select("line", F.xxhash64("line").alias("h")).collect()}
    wide = r"[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]]+|\S"
    tokens = {x: regex.findall(wide, x, regex.V1) if len(x.encode()) > 2 * len(x) else x.split()
              for x in lines}
    links = [r.asDict() for r in line_edit_join.line_links(
        frame(spark, ["\n".join(lines[i::7]) for i in range(7)])).collect()]
    distinct, want = sorted(set(lines)), {}
    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            a, b = tokens[x], tokens[y]
            k = budget_of(min(len(a), len(b)))
            if k and abs(len(a) - len(b)) <= k and (e := levenshtein(a, b)) <= k:
                want[frozenset((x, y))] = e
    found = {frozenset((key[r["a"]], key[r["b"]])): r["edits"] for r in links}
    assert len(found) == len(links) and found == want
    assert groups_of(distinct, map(tuple, found)) == groups_of(distinct, map(tuple, want))
    return found, want


@pytest.mark.parametrize("hot", [1, 12])
def test_line_links_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_edit_join, "HOT", hot)
    rng = random.Random(6)
    v = vocabulary(6, 25)
    base = [rng.choices(v, k=n) for n in [7, 8, 9, 31, 32, 33, 71, 72, 73, 110, 127, 128] * 2]
    lines = [" ".join(edited(x, k, rng)) for x in base for k in (0, 0, 1, 2, 3, 4, 5, 6, 1)]
    lines += ["  ".join(base[4]) + " \t", "日本語のテキストはここにあります。", "日本語のテキストがここにあります。"]
    found, want = check_lines(spark, lines)
    assert len(want) > 100 and (hot == 1 or len(found) == len(want))


def test_lines_of_one_template(spark):
    rng = random.Random(13)
    base, lines = vocabulary(13, 60), []
    for _ in range(100):                       # most differ in several words
        ws = list(base)
        for _ in range(rng.choice([0, 3, 3, 3, 4])):
            ws[rng.randrange(60)] = "".join(rng.choice("abcdef") for _ in range(5))
        lines += [" ".join(ws), " ".join(edited(ws, rng.randint(0, 2), rng))]
    # and lines that share a passage only
    lines += [" ".join(base[:20] + vocabulary(i, 30)) for i in range(100, 160)]
    found, want = check_lines(spark, lines)
    assert len(want) > 60


def test_no_link_of_near_copies_is_left_out(spark):
    rng, base = random.Random(3), vocabulary(21, 70)
    lines = {" ".join(edited(base, rng.randint(1, 2), rng)) for _ in range(150)}
    found, want = check_lines(spark, [" ".join(base), *sorted(lines - {" ".join(base)})])
    assert len(want) > 10 * len(lines)


@pytest.mark.parametrize("hot, chunk", [(12, 50), (1, 3)])
def test_links_are_counted_without_a_row_for_each(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(line_edit_join, "HOT", hot)
    monkeypatch.setattr(line_edit_join, "CHUNK", chunk)
    rng, v, lines = random.Random(31), vocabulary(31, 40), set()
    for n, copies in ((60, 200), (20, 12), (33, 12)) if hot > 1 else ((20, 12), (33, 12), (71, 9), (72, 9)):
        base = rng.choices(v, k=n)
        for _ in range(copies):
            ws = list(base) if copies == 200 else edited(base, rng.randint(1, 4), rng)
            ws[rng.randrange(len(ws))] = "".join(rng.choice("abcdef") for _ in range(6))
            lines.add(" ".join(ws))
    d, handed, plain = frame(spark, sorted(lines)), [], line_edit_join.components
    links = {(r["a"], r["b"]) for r in line_edit_join.line_links(d).collect()}

    def recorded(given, *ends):
        handed.append(given.count())
        return plain(given, *ends)

    monkeypatch.setattr(line_edit_join, "components", recorded)
    got = line_edit_join.line_dedup(d).toPandas()
    degrees = Counter(x for pair in links for x in pair)
    assert dict(zip(got["class_id"], got["n_links"])) == {x: degrees[x] for x in got["class_id"]}
    assert {frozenset(g) for _, g in got.groupby("group_id")["class_id"]} == groups_of(got["class_id"], links)
    assert hot == 1 or (len(links) > 10_000 and handed[0] < len(links) / 2)


def test_long_lines_and_one_word_of_many(spark):
    v, rng = vocabulary(9, 300), random.Random(9)
    long_ = rng.choices(v, k=2000)
    some = rng.choices(v, k=31)
    lines = [" ".join(some), " ".join([*some[:12], "other", *some[13:]]), " ".join(long_),
             " ".join(edited(long_, 14, rng)), " ".join(edited(long_, 60, rng))]
    found, _ = check_lines(spark, lines)
    assert {frozenset(lines[:2]): 1}.items() <= found.items() and frozenset(lines[2:4]) in found


def test_line_dedup_keeps_the_first(spark):
    line = "the quick brown fox jumps over the lazy dog today"
    d = frame(spark, [f"{line}\nother\n{line}", f"{line}!\nother", "\n \nshort", "short"])
    got = line_edit_join.line_dedup(d).toPandas().sort_values(["doc_id", "line_no"])
    assert got["kept"].tolist() == [True, True, False, False, False, True, False]
    assert got["n_links"].tolist() == [1, 0, 1, 1, 0, 0, 0]
    assert got["group_id"].nunique() == 3 and got["class_id"].nunique() == 4
    text = {r["doc_id"]: r["text"] for r in line_edit_join.dedup_text(d).collect()}
    assert text == {0: f"{line}\nother", 1: "", 2: "\n \nshort", 3: ""}


# ------------------------------------------------------------- 6 licences

def test_licences(spark, docs):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    a = licence_digests.licence_hits(table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    b = con.sql(licence_digests.LICENCE_SQL).df()
    cols = sorted(a.columns)
    assert sorted(map(str, a[cols].itertuples(index=False, name=None))) == sorted(
        map(str, b[cols].itertuples(index=False, name=None))) and len(a) > 10


def test_licence_spellings(spark):
    known = dict(licence_digests.known_texts()[::-1])
    files = {k: t for k, t in licence_digests.known_texts() if len(t) > 400}
    mit, isc = (next(t for k, t in licence_digests.known_texts() if k == n) for n in ("MIT", "ISC"))
    bsd = next(t for k, t in licence_digests.known_texts() if k == "BSD-3-Clause")
    gpl = next(t for k, t in licence_digests.known_texts() if k == "GPL-3.0" and len(t) > 20_000)
    assert {"MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
            "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense", "Zlib"} <= files.keys() <= known.keys()

    def wrapped(text, width):
        blocks = [" ".join(p.split()) for p in text.split("\n\n")]
        return "\n\n".join("\n".join(textwrap.wrap(p, width)) for p in blocks)

    texts = {
        "title": "MIT License\n\nCopyright (c) 2021 Jane Doe\n\n" + mit,
        "named": "The MIT License (MIT)\n\nCopyright Jane Doe <j@x.org>\nCopyright 2001, Other\n\n" + mit,
        "sign": "\u00a9 2020 Someone\nAll rights reserved.\n\n" + mit.upper(),
        "wrapped": wrapped(mit, 40), "isc": wrapped(isc, 61), "isc2": "ISC License\n\n" + wrapped(isc, 33),
        "bsd": "Copyright (c) 1999, A\n" * 3 + "\n" + wrapped(bsd, 50), "gpl": gpl.upper().replace("\n", "\n//   "),
        "spelled": mit.replace("sublicense", "sub-licence").replace(" and ", " & "),
        "within": "# A tool\n\nsome words\n\n## Licence\n\nCopyright 2020 X\n\n" + mit + "\n\nThanks!",
        "cut": mit[:-30], "changed": mit.replace("free of charge", "for a fee"),
        "notice": "a\n * Licensed under the Apache Licence, version 2.0.\nb",
    }
    d = frame(spark, list(texts.values()))
    names = list(texts)
    got = defaultdict(set)
    for r in licence_digests.licence_hits(d).collect():
        got[names[r["doc_id"]]].add((r["scope"], r["licence"], r["place"]))
    for name in ("title", "named", "sign", "wrapped", "spelled"):
        assert ("document", "MIT", 0) in got[name], name
    assert ("document", "ISC", 0) in got["isc"] & got["isc2"]
    assert ("document", "BSD-3-Clause", 0) in got["bsd"]
    assert ("document", "GPL-3.0", 0) in got["gpl"]
    assert got["within"] == {("paragraphs", "MIT", 4)}
    assert got["notice"] == {("line", "Apache-2.0", 2)}
    assert got["cut"] == got["changed"] == set()
    # the body's own lines aren't copyright lines, wherever they are wrapped
    assert licence_digests.paragraphs("x granted, provided that the above\ncopyright notice and this\n"
                                      "Copyright Holder and\ncopyright holders") == [
        "x granted provided that the above copyright notice and this copyright holder and copyright holders"]



# ------------------------------------------------- 7 language, 9 toxicity

def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_centroids.identify(docs, language_centroids.fit_languages(docs))
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(rows) > 200 and (rows["lang"] == rows["lang_pred"]).mean() > 0.97
    assert rows["score"].between(0, 1).all() and rows["rejected"].mean() < 0.1
    model = language_centroids.fit_languages(docs)
    assert model.predict(["Ωμέγα άλφα " * 30])[0][3] and model.predict(["12 34", None]) == [
        ("und", 0.0, 1.0, True)] * 2


def test_language_by_brute_force(spark, docs, texts):
    model = language_centroids.fit_languages(docs)

    def vector(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        line = " " + " ".join(letters.split()) + " "
        grams = Counter()
        for n in (1, 2, 3):
            for i in range(len(line) - n + 1):
                gram = line[i:i + n]
                if n > 1 or gram != " ":
                    h = 0
                    for c in gram:
                        h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
                    grams[((h * 0x9E3779B1 + n) & 0xFFFFFFFF) >> (32 - 12)] += 1
        out = np.zeros(language_centroids.DIMENSIONS)
        for place, n in grams.items():
            out[place] = (1 + np.log(n)) * model.idf[place]
        return out / max(np.linalg.norm(out), 1e-12)

    for _, text in texts[:120]:
        [(lang, score, *_)] = model.predict([text])
        if not any(c.isalpha() for c in text or ""):
            assert lang == "und"
            continue
        near = model.centres.astype(float) @ vector(text)
        assert abs(near.max() - score) < 1e-4 and lang == model.languages[int(near.argmax())]


def test_language_of_symbols_and_copies(spark, docs):
    model = language_centroids.fit_languages(docs, max_rows=60)
    emoji, astral = "\U0001F600\U0001F601", "\U00020000\U00020001"      # no letters; letters
    assert model.predict([emoji, f"12 {emoji}!", astral])[0][:2] == ("und", 0.0)
    assert model.predict([f"12 {emoji}!"])[0][0] == "und" and model.predict([astral])[0][0] != "und"
    # a text of half of all rows is one of the sample
    row = docs.filter("lang = 'en' and length(text) > 500").filter(~held_out(F.col("doc_id"))).limit(1)
    copies = row.withColumn("doc_id", F.explode(F.sequence(F.lit(10_000), F.lit(10_400)))).select(
        *docs.columns)
    again = language_centroids.fit_languages(docs.unionByName(copies), max_rows=60)
    assert again.languages == model.languages and np.allclose(again.centres, model.centres)


def test_held_out_rule(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


def test_toxicity_finds_expressions(spark):
    v, bad = vocabulary(3, 600), ["grumblewort", "snarkfoozle", "dreckkopfig"]
    rng = random.Random(9)

    def text(toxic):
        ws = rng.choices(v, k=rng.randint(80, 300))
        for _ in range(rng.randint(3, 6) if toxic else 0):
            ws.insert(rng.randrange(len(ws)), rng.choice(bad))
        return " ".join(ws)

    y = [rng.random() < 0.2 for _ in range(900)]
    x = [text(t) for t in y]
    model = toxicity_zstd.fit(x[:600], np.array(y[:600]), np.ones(600))
    p = model.scores(x[600:]) >= toxicity_zstd.THRESHOLD
    truth = np.array(y[600:])
    assert (p & truth).sum() >= 0.9 * truth.sum() and (p & ~truth).sum() <= 0.02 * (~truth).sum()
    # other words move nothing: the dictionaries decide, window by window
    data, segments, owner = toxicity_zstd.windows([b"", b"a" * 500])
    assert owner.tolist().count(0) == 1 and segments[owner == 1][-1].sum() == 500


# --------------------------------------------------------- 8 benchmark

def test_myers_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(200):
        p = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 70)))
        t = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 120)))
        row = [0] * (len(t) + 1)
        for i, x in enumerate(p, 1):
            new = [i]
            for j, y in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert decontaminate.myers(decontaminate.masks(p), len(p), t)[0] == min(row)


def edited_text(text, n, rng):
    for _ in range(n):
        i, what = rng.randrange(len(text) + 1), rng.randrange(3)
        text = text[:i] + (rng.choice("xyé") if what else "") + text[i + (what != 1):]
    return text


@pytest.mark.parametrize("block_chars", [2_000_000, 300])
def test_leaks_equal_brute_force(spark, block_chars):
    rng = random.Random(5)
    v = vocabulary(5, 300)
    items = [" ".join(rng.choices(v, k=rng.randint(6, 40))) for _ in range(12)]
    texts = []
    for i, item in enumerate(items * 4):
        errors = decontaminate.budget(len(item))
        body = edited_text(item, (0, errors, errors + 1, errors + 4)[i // 12], rng)
        texts.append(" ".join(rng.choices(v, k=50)) + "; " + body.title() + "\n" + " ".join(rng.choices(v, k=9)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.contaminated(
        frame(spark, texts), bench, block_chars=block_chars).collect()}
    want = {}
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            p = decontaminate.normal(item)
            d = decontaminate.myers(decontaminate.masks(p), len(p), decontaminate.normal(t))[0]
            if d <= decontaminate.budget(len(p)):
                want[i, j] = d
    assert got == want and len(want) >= 20
    left = decontaminate.drop_contaminated(frame(spark, texts), bench, block_chars=block_chars)
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {i for i, _ in want}


# ----------------------------------------------------- 10 near-duplicates

def brute_classes(texts, threshold=order_minhash.THRESHOLD):
    parts = [order_minhash.marked_shingles([t], order_minhash.WORDS)[0] for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    first = {}
    for i, t in enumerate(texts):
        if (j := first.setdefault(t or "", i)) != i:
            root[find(i)] = find(j)
    for i in range(len(texts)):
        for j in range(i):
            a, b = len(parts[i]), len(parts[j])
            if a and b and min(a, b) >= threshold * max(a, b):
                m = order_minhash.aligned(parts[i], parts[j], max(a, b))
                if m >= threshold * (a + b - m) - 1e-9:
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_of_the_table(docs, texts):
    got = {r["id"]: r["class_id"] for r in order_minhash.near_duplicates(docs).collect()}
    want = brute_classes([t for _, t in texts])
    assert got == {texts[i][0]: texts[w][0] for i, w in enumerate(want)}


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicate_groups(spark, block):
    rng = random.Random(12)
    v, texts = vocabulary(12, 900), []
    for group in range(8):
        base = rng.choices(v, k=120)
        for _ in range(25 if group == 0 else 4):
            ws = list(base)
            for _ in range(rng.randint(0, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(v)
            texts.append(" ".join(ws).capitalize() + ".")
    # the same sentences in another order are no near-duplicate
    base = rng.choices(v, k=120)
    texts += [" ".join(base), " ".join(base[60:] + base[:60])]
    got = {r["id"]: r["class_id"] for r in order_minhash.near_duplicates(
        frame(spark, texts), block=block).collect()}
    want = brute_classes(texts)
    assert got == dict(enumerate(want)) and got[len(texts) - 1] != got[len(texts) - 2]


def test_alignment_and_shingles():
    one, begin = order_minhash.marked_shingles(["a b c d e f g", "a b", "", None, "x " * 9], 5)
    assert np.diff(begin).tolist() == [3, 1, 0, 0, 5] and len(set(one[begin[4]:].tolist())) == 5
    a = np.arange(100, dtype=np.uint64)
    assert order_minhash.aligned(a, np.r_[a[50:], a[:50]], 100) == 50
    assert order_minhash.aligned(a, np.r_[a[1:], a[:1]], 2) == 99
    b = a.copy()
    b[[3, 50]] = b[[50, 3]]
    assert order_minhash.aligned(a, b, 10) == 98


def common_subsequence(a, b, band):
    """By dynamic programming over all cells of the band."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y and abs(i - j) <= band)))
        row = new
    return row[-1]


def test_alignment_equals_dynamic_programming():
    rng = random.Random(21)
    for n in range(400):
        kinds = rng.choice([1, 2, 4, 30, 500])
        a = [rng.randrange(kinds) for _ in range(rng.randint(0, 60))]
        b = list(a) if n % 2 else [rng.randrange(kinds) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(4)] = [rng.randrange(kinds)] * rng.randrange(4)
        x, y, band = np.array(a, np.uint64), np.array(b, np.uint64), rng.choice([0, 1, 5, 20, 100])
        want = common_subsequence(a, b, band)
        assert order_minhash.aligned(x, y, band) == want
        assert order_minhash._aligned_bits(x, y, band) == want


def test_near_duplicates_with_a_repeated_passage(spark):
    v = vocabulary(22, 900)
    b, c, d = v[:60], v[60:240], v[240:540]
    texts = [" ".join(b + c + b + d), " ".join(c + b + d), " ".join(v[540:])]
    x, y = (np.unique([" ".join(t.split()[i:i + 5]) for t in texts[:2]
                       for i in range(len(t.split()) - 4)], return_inverse=True)[1][s]
            for s in (slice(None, 596), slice(596, None)))
    m = common_subsequence(x.tolist(), y.tolist(), 1000)
    assert m / (len(x) + len(y) - m) > 0.85
    got = {r["id"]: r["class_id"] for r in order_minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_buckets_of_different_pairs_are_all_verified(spark):
    # two pairs each whose sums of 40-bit key hashes are equal
    same = [(16653, 6, 19), (28041, 17, 18), (14855, 4, 16), (33615, 1, 11)]
    texts = [" ".join(f"w{g}x{j}" for j in range(40)) + f" v{k}" for g, *ks in same for k in ks]
    got = {r["id"]: r["class_id"] for r in order_minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == {i: i // 2 * 2 for i in range(8)}


def test_word_hashes_across_blocks(monkeypatch):
    text = " ".join(vocabulary(1, 3000)) + " " + "y" * 5000 + " Éa,b"
    whole = textvec.word_hashes([text])[0]
    monkeypatch.setattr(textvec, "_BLOCK", 700)
    assert (textvec.word_hashes([text])[0] == whole).all()
    assert len(whole) == 3003


def test_registered_queries():
    by = defaultdict(list)
    for name in queries.QUERIES:
        by[name.split("_")[0]].append(name)
    assert sorted(by, key=lambda x: int(x[2:])) == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)
