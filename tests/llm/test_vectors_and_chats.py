"""Embedding links and chat formatting against plain versions; connected components."""

import random

import numpy as np
from pyspark.sql import functions as F

from panelcast.llm import chat, embedding_join
from panelcast.llm.queries import QUERIES
from panelcast.llm.shared import components
from tests.llm import brute


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows],
                                 "vec_id bigint, embedding array<float>, label int, rep string, valid int")


def test_links(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(30):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + 0.25 * rng.standard_normal(16)]))
    chain = np.linspace(0, 3, 60)
    rows += [(1000 + i, [float(np.float32(np.cos(a))), float(np.float32(np.sin(a)))]) for i, a in enumerate(chain)]
    rows += [(2000 + i, rows[3][1]) for i in range(40)] + [(2100, [2 * x for x in rows[3][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [float("inf")] + [1.0] * 15),
             (3005, [None] + [1.0] * 15), (3006, [1e-38] * 16), (3007, [1e38] * 16)]
    want = brute.vectors(rows)
    for cell, block, chunk in ((4096, 2048, 8192), (20, 16, 64)):
        monkeypatch.setattr(embedding_join, "PER_CELL", cell)
        monkeypatch.setattr(embedding_join, "BLOCK", block)
        monkeypatch.setattr(embedding_join, "QUERIES", chunk)
        got = embedding_join.near_vectors(_vectors(spark, rows)).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_nothing(spark):
    assert embedding_join.near_vectors(_vectors(spark, [])).count() == 0
    got = embedding_join.near_vectors(_vectors(spark, [(1, None), (2, [0.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2)]
    got = embedding_join.near_vectors(_vectors(spark, [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert [r.n_links for r in got] == [2, 2, 2] and {r.component_id for r in got} == {5}


def test_cells_are_searched_far_enough():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((800, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pivots, r = x[:20], np.sqrt(0.2)
    home, own, _ = embedding_join.cell_targets(x, pivots, None, r)
    radii = np.array([[own[home == c].min(), own[home == c].max()] for c in range(20)])
    _, _, mask = embedding_join.cell_targets(x, pivots, radii, r)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert mask[a, home[b]].all() and mask.mean() < 0.7


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, rng.randrange(6, 80)) for _ in range(60)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute.components({n for e in edges for n in e}, edges)
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PIECES = ["<|im_start|>", "<|im_end|>", "<|nl|>", "<*|im_end|>", "<**|nl|>", "\n", "<", "|", "*", ">", "im_end", "a", " ", "é😀",
          "assistant", "user"]


def test_round_trip_of_any_content():
    rng = random.Random(7)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
    for _ in range(3000):
        turns = [(rng.choice(["assistant", "user", text()]), text()) for _ in range(rng.randrange(4))]
        shown, spans = chat.render(turns)
        assert chat.parse(shown) == turns
        assert [chat.unescape(shown[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert chat.parse("<|im_start|>user\nx") is None and chat.parse("x") is None and chat.parse("") == []


def test_plain_text_is_not_escaped():
    assert chat.render([("user", "a <b> |c| *")])[0] == "<|im_start|>user\na <b> |c| *<|im_end|>\n"


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "a"), (2, None, None, "x"), (2, 0, "assistant", ""),
            (None, 0, "user", "<|im_end|>"), (3, 0, "assistant", "dup"), (3, 0, "assistant", "dup")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, r int")
    got = {r.conv_id: r for r in chat.format_chats(df).withColumn("turns", chat.parsed(F.col("formatted")))
           .withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", ""), ("assistant", "a"), ("assistant", "b")]
    assert [(t.role, t.text) for t in got[2].turns] == [("", "x"), ("assistant", "")]
    assert got[None].turns[0].text == "<|im_end|>" and got[3].loss == "dupdup" and got[1].loss == "ab" and got[2].loss == ""
    assert chat.format_chats(df.limit(0)).count() == 0


def test_registered_query_has_the_extra_conversation(spark, root):
    row = QUERIES["op6_chat_format"](spark, root).where("conv_id = -1").collect()
    said = "<|im_end|><|im_start|>assistant ok"
    assert len(row) == 1 and row[0].n_turns == 2 and row[0].loss_sha256 == brute.sha(said)
    assert row[0].turns_sha256 == brute.sha(f"user\n{said}\nassistant\n{said}\n")
