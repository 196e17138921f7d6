"""Random put sequences against a plain last-write-wins model."""

import uuid

from hypothesis import given, settings
from hypothesis import strategies as st

from medstar.operators.wide_table import WideTable

KEYS = st.sampled_from(["RN32_001", "RN32_002", "RN33_000", "a", ""])
CELL = st.one_of(st.none(), st.sampled_from(["x", "y", "", "z1"]))
BATCH = st.lists(st.tuples(KEYS, CELL, CELL, st.sampled_from(["f1", "f2"])), max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(BATCH, min_size=1, max_size=3))
def test_latest_view_matches_model(spark, batches):
    t = WideTable.create(spark, f"wm_{uuid.uuid4().hex[:8]}")
    model: dict = {}
    for version, batch in enumerate(batches, start=1):
        df = spark.createDataFrame(batch, "k string, title string, content string, src string")
        t.put(t.cells(df, "k", {"specific:title": "title", "specific:content": "content"},
                      source="src"), version)
        for cell in ("title", "content"):
            # newest version wins; inside a batch the larger (source, value)
            best: dict = {}
            for k, title, content, src in batch:
                v = title if cell == "title" else content
                if v is not None and (k not in best or (src, v) > best[k]):
                    best[k] = (src, v)
            for k, (_, v) in best.items():
                model[(k, cell)] = v
    got = {}
    for r in t.latest(["specific:title", "specific:content"]).collect():
        for cell in ("title", "content"):
            if r["specific"][cell] is not None:
                got[(r["row_key"], cell)] = r["specific"][cell]
    assert got == model
