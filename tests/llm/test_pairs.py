"""Token alignment, the parity-sketch join and hard negatives: brute force, SQL and odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylens.llm import alignment, components, fetch, hard_negatives, near_dedup, parity_join
from staylens.llm.oracles import ORACLES
from staylens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
ODD = [None, "", " ", "a", "two  spaces\n\nand\tmore ", "<|endoftext|> <s> ▁ ﬁ é", "東京 " * 50, "x" * 5000, "\x00nul", "same words here", "same words here"]
CLASHING = "doc_id bigint, text string, node string, key bigint, mark int, links binary, page int, bits binary, n bigint"


def clashing(spark, texts):
    rows = [(i, t, "n", 1, 2, None, 3, None, 4) for i, t in enumerate(texts)]
    rows += [(None, "no id at all", None, None, None, None, None, None, None)] * 2 + [(1, "id again", "n", 1, 2, None, 3, None, 4)]
    return spark.createDataFrame(rows, CLASHING)


# ---------------------------------------------------------------- alignment


def decoded_bytes(tokenizer: Tokenizer, ids: list[int]) -> list[bytes]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in ids]


def aligned_by_hand(texts: list[str | None]) -> list[tuple]:
    """Tokens of both libraries, ends compared one by one."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    rows, pairs = [], Counter()
    for text in texts:
        a, b = [], []
        if text:
            data = (" " + text).encode()
            a = tokenizer.encode(" " + text, add_special_tokens=False).ids
            b = model.encode(text)
            bytes_a = decoded_bytes(tokenizer, a)
            bytes_b = [
                bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ]
            if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
                a, b = [], []
        made, links, i, j = [], [], 0, 0
        group_a, group_b, end_a, end_b = [], [], 0, 0
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                group_a.append(a[i])
                end_a += len(bytes_a[i])
                i += 1
            else:
                group_b.append(b[j])
                end_b += len(bytes_b[j])
                j += 1
            if end_a == end_b:
                made.append(f"{','.join(map(str, group_a))}|{','.join(map(str, group_b))}")
                links.append((group_a[-1], group_b[-1]))
                group_a, group_b = [], []
        pairs.update(links)
        rows.append((len(a), len(b), ";".join(made), links))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(links), len(links), sum(pairs[x] == best[x[1]] for x in links), sum(pairs[x] for x in links),
         hashlib.sha256(made.encode()).hexdigest() if made else "")
        for n_a, n_b, made, links in rows
    ]


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip((r.doc_id for r in docs), aligned_by_hand([r.text for r in docs]), strict=True))
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in QUERIES["op11_alignment"](spark, SF).collect()}
    assert got == want and sum(x[2] for x in want.values()) > 10_000


def test_alignment_of_odd_rows(spark):
    docs = clashing(spark, ODD)
    texts = ODD + ["no id at all"] * 2 + ["id again"]
    got = alignment.alignment(docs, A, B).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    ids = [*range(len(ODD)), None, None, 1]
    assert sorted(((r.doc_id, *(r[c] for c in COUNTS)) for r in got), key=key) == sorted(
        ((i, *x) for i, x in zip(ids, aligned_by_hand(texts), strict=True)), key=key
    )
    assert alignment.alignment(docs.limit(0), A, B).count() == 0
    assert alignment.groups(docs.limit(0), A, B).count() == alignment.overlaps(docs.limit(0), A, B).count() == 0


def test_groups_give_back_the_text(spark):
    texts = {i: t for i, t in enumerate(["plain words of a sentence", "東京 é ﬂ", "worldwide unbelievable " * 40])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    v = alignment.vocabularies(A, B)
    rows = alignment.groups(docs, A, B).orderBy("doc_id", "group").collect()
    for i, text in texts.items():
        mine = [r for r in rows if r.doc_id == i]
        data = (" " + text).encode() if mine else b""
        for r in mine:
            part = data[r.start_byte : r.end_byte]
            assert b"".join(v.bytes_a[x] for x in r.ids_a) == part == b"".join(v.bytes_b[x] for x in r.ids_b)
        assert [r.first_a for r in mine] == np.cumsum([0] + [len(r.ids_a) for r in mine])[:-1].tolist()
        assert [r.first_b for r in mine] == np.cumsum([0] + [len(r.ids_b) for r in mine])[:-1].tolist()
    assert {r.doc_id for r in rows} >= {0, 2}


def test_overlap_ranges_by_hand(spark):
    texts = ["plain words of a sentence", "antidisestablishmentarianism isn't short", "é" * 40, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    v = alignment.vocabularies(A, B)
    got = {(r.doc_id, r.token): (r.side, r.first_other, r.last_other) for r in alignment.overlaps(docs, A, B).collect()}
    want = {}
    for i, text in enumerate(texts):
        found = alignment.align_texts([text], v)
        spans = {
            s: list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if len(ends) else []
            for s, ends in (("a", found.ends_a), ("b", found.ends_b))
        }
        side = "a" if len(spans["a"]) <= len(spans["b"]) else "b"
        for k, (x, y) in enumerate(spans[side]):
            met = [m for m, (p, q) in enumerate(spans["b" if side == "a" else "a"]) if p < y and x < q]
            want[i, k] = (side, met[0], met[-1])
    assert got == want and want


def test_gallop_finds_places():
    rng = np.random.default_rng(5)
    into = np.unique(rng.integers(0, 5000, 900))
    low = rng.integers(0, len(into) - 1, 400)
    high = np.minimum(low + 1 + rng.integers(0, 500, 400), len(into))
    guess = low + rng.integers(0, 1 << 30, 400) % (high - low)
    values = rng.integers(-10, 5010, 400)
    want = [lo + int(np.searchsorted(into[lo:hi], v)) for v, lo, hi in zip(values, low, high, strict=True)]
    assert alignment.gallop(values, into, low, high, guess).tolist() == want


def test_every_linked_pair_has_a_number():
    rng = random.Random(1)
    tokens = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 5))) for _ in range(60)]
    a, b = tokens[:30], tokens[30:]
    want = sorted(i * 30 + j for i in range(30) for j in range(30) if a[i].endswith(b[j]) or b[j].endswith(a[i]))
    assert alignment._ending_pairs(a, b).tolist() == want


# ---------------------------------------------------------------- parity-sketch join


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, min(len(w), 1)))}


def linked_by_hand(texts: list[str | None], percent: int) -> list[int]:
    """Component of every text, as the least place that links reach."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def near_copies(seed: int, sizes=(1, 3, 5, 6, 7, 9, 14, 30, 80, 300)) -> list[str]:
    """Groups of texts that are more or less alike, chains among them, and texts with a passage in common."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    out = []
    for size in sizes:
        for _ in range(4):
            base = [word() for _ in range(size)]
            for edits in (0, 0, 1, 2, 3, max(1, size // 60), size // 30, size // 15):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = word()
                out.append(" ".join(copy + [word() for _ in range(rng.choice((0, 0, 1, size // 10)))]))
            out.append(" ".join(base[: size // 2] + passage + base[size // 2 :]))
            chain = list(base)
            for _ in range(5):
                chain = [*chain[max(1, size // 20) :], *(word() for _ in range(max(1, size // 20)))]
                out.append(" ".join(chain))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "percent", "hot"), [(1, 80, False), (2, 80, True), (3, 90, False), (4, 70, False)])
def test_components_against_all_pairs(spark, monkeypatch, seed, percent, hot):
    if hot:  # every second key is split over many buckets
        keys = lambda base, percent: (np.arange(0, 1 << 20), np.full(1 << 20, 7))
        monkeypatch.setattr(parity_join, "_hot_keys", keys)
        monkeypatch.setattr(parity_join, "_keys", (lambda f: lambda *a: f(*a) >> np.uint64(27))(parity_join._keys))
    texts = near_copies(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    out, links = parity_join.jaccard_links(docs, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()}
    want = linked_by_hand(texts, percent)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in enumerate(texts)}
    assert all(100 * r.common >= percent * r.total for r in links.collect())
    assert 10 < len(set(want)) < len(texts) - 100


def test_like_sets_share_a_key():
    """Pairs at the very threshold, of sizes at every edge of a band, and with hardly any words that are not empty."""
    rng, tried = np.random.default_rng(8), 0
    for percent in (70, 80, 95):
        how = parity_join.layouts(percent)
        for n in [*range(1, 40), *(int(e) + d for e in how.edges[(how.edges > 40) & (how.edges < 900)] for d in (-1, 0))]:
            for gone in {0, how.apart(2 * n) // 2, n - -(-n * percent // 100)}:
                for more in {0, gone, n * 100 // percent - n}:
                    x = np.unique(rng.integers(0, 1 << 62, n + more, np.int64)).astype(np.uint64) * np.uint64(4)
                    x = rng.permutation(x)
                    small, large = np.unique(x[:n]), np.unique(x[gone:])
                    apart = len(np.setxor1d(small, large))
                    sketches = [parity_join.bit_sketch(s).view(np.uint64) for s in (small, large)]
                    assert np.bitwise_count(sketches[0] ^ sketches[1]).sum() <= apart
                    if 100 * (n - gone) >= percent * (n + more) and n > gone:
                        assert np.intersect1d(parity_join.bucket_keys(small, how), parity_join.bucket_keys(large, how)).size
                        tried += 1
    assert tried > 300
    # all shingles in one word of the sketch: too few words that are not empty
    low = np.arange(1, 101, dtype=np.uint64)
    how = parity_join.layouts(80)
    assert np.intersect1d(parity_join.bucket_keys(low, how), parity_join.bucket_keys(low[:85], how)).size
    with pytest.raises(ValueError, match="70"):
        parity_join.layouts(50)


def test_join_of_odd_rows(spark):
    docs = clashing(spark, ODD)
    out, links = parity_join.jaccard_links(docs)
    rows = out.collect()
    assert len(rows) == len(ODD) + 3 and links.count() == 0
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id == 9} == {(1, 9)}
    assert {(r.n_shingles, r.component_id) for r in rows if r.doc_id == 10} == {(1, 9)}
    assert all((r.n_shingles, r.component_id) == (0, r.doc_id) for r in rows if r.doc_id in (0, 2))
    assert [(r.n_shingles, r.component_id) for r in rows if r.doc_id is None] == [(1, None)] * 2
    assert sorted(r.n_shingles for r in rows if r.doc_id == 1) == [0, 1]
    none, links = parity_join.jaccard_links(docs.limit(0))
    assert none.count() == links.count() == 0


def test_marked_rows(spark):
    table = spark.range(5000).select(F.xxhash64("id").alias("h"), "id", F.lit(1).alias("page"), F.lit("x").alias("bits"))
    wanted = table.where("id % 50 = 0").select("h")
    got = fetch.marked_rows(table, "h", wanted)
    assert got.columns == table.columns
    ids = {r.id for r in got.collect()}
    assert ids >= set(range(0, 5000, 50)) and len(ids) < 130
    assert fetch.marked_rows(table, "h", wanted.limit(0)).count() == 0


# ---------------------------------------------------------------- hard negatives


def by_sql(folder_or_rows, con=None) -> list[tuple]:
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{folder_or_rows}'")
    return sorted(con.sql(ORACLES["op13_hard_negatives"]).fetchall())


@pytest.mark.parametrize("fanout", [2, 5, 16])
def test_hard_negatives_against_sql(spark, tmp_path, monkeypatch, fanout):
    """Clusters of very unlike lengths, equal vectors, ties, short vectors; small blocks, so that leaves are cut."""
    rng = np.random.default_rng(fanout)
    centres = rng.normal(0, 1, (12, 8))
    rows = []
    for i in range(1500):
        v = centres[rng.integers(12)] * (0.2 if i % 3 else 5) + rng.normal(0, 0.1, 8)
        rows.append((i * 4, [float(x) for x in (v if i % 5 else np.round(v))], int(rng.integers(4))))
    rows += [(k, [1.0] * 8, 3) for k in (100, 100, 300, 7, 700)] + [(1100, [0.0] * 8, 1), (1300, [], 1), (1500, [2.0, 1.0], 2)]
    rows += [(2500, None, 1), (2700, [1.0, None], 1), (2900, [float("nan")], 1), (3100, [float("inf")], 1), (3300, [1.0], None), (-200, [-1.0] * 8, 0)]
    at = str(tmp_path / "vectors")
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").coalesce(1).write.parquet(at)
    monkeypatch.setattr(hard_negatives, "BLOCK", 90)
    kept = hard_negatives.vectors(spark.read.parquet(at))
    index = hard_negatives.build_index(kept, fanout, sample_rows=300, block=90)
    assert index.rows.groupBy("block").count().agg(F.max("count")).first()[0] < 250
    monkeypatch.setattr(hard_negatives, "build_index", lambda rows: index)
    monkeypatch.setattr(hard_negatives, "vectors", lambda rows: kept)
    got = sorted(map(tuple, hard_negatives.hard_negatives(spark.read.parquet(at)).collect()))
    assert got == by_sql(next(Path(at).glob("*.parquet"))) and len(got) > 300


def test_ranges_leave_out_only_leaves_without_results():
    rng = np.random.default_rng(2)
    rows = np.round(rng.normal(0, 60, (3000, 6)) + rng.normal(0, 400, (8, 6))[rng.integers(8, size=3000)]).astype(np.int64)
    longest = float((rows**2).sum(axis=1).max()) + 1
    tree, ranges = hard_negatives.build(rows[:600], longest, 6), {}
    leaf = hard_negatives.descend(tree, rows, ranges)
    for node in tree.nodes:
        node.low, node.high = ranges.get(node.number, np.stack([np.full((len(node.children),) * 2, np.inf)] * 2))
    anchors = rows[::100]
    scores = hard_negatives.products(anchors, rows)
    least, most = scores.max(axis=1, keepdims=True) // 2, scores.max(axis=1, keepdims=True) * 6 // 10
    alive = hard_negatives.surviving(tree, anchors, least, most)
    inside = (scores >= least) & (scores <= most)
    for a in range(len(anchors)):
        assert alive[a][leaf[inside[a]]].all()
    assert alive.mean() < 0.8  # and many leaves are left out


def test_products_beyond_floating_point_are_exact():
    x = np.array([[(1 << 29) + 1, 3]], np.int64)
    assert hard_negatives.products(x, x).tolist() == [[((1 << 29) + 1) ** 2 + 9]]


def test_hard_negatives_of_odd_tables(spark):
    kind = "vec_id bigint, embedding array<float>, label int, row string, leaf string, block string, q string"
    none = spark.createDataFrame([], kind)
    assert hard_negatives.hard_negatives(none).count() == 0
    rows = [(0, [1.0, 0.0], 1, "r", "l", "b", "q"), (None, [1.0, 0.0], 1, None, None, None, None), (1, [3e38, 1.0], 1, "", "", "", "")]
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, kind)).count() == 0
    rows += [(5, [0.9, 0.0], 2, "r", "l", "b", "q"), (6, [0.5, 0.0], 1, "r", "l", "b", "q"), (8, [0.4, 0.2], 3, "r", "l", "b", "q")]
    got = [tuple(r)[:6] for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, kind)).collect()]
    # 0 is divisible by 7: its label becomes 2, so that 5 is its positive
    assert sorted(got) == [(0, 5, 1, 6, 58880, 32768), (0, 5, 2, 8, 58880, 26112)]


def stored_tables(spark, name):
    """Paths of the intermediate tables of a name."""
    return {str(p) for p in Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).glob(f"{name}-*")}


def test_rows_that_meet_in_buckets_are_narrow(spark):
    """Near copies and exact copies in several tasks: buckets hold numbers, and one text of each node is fetched."""
    texts = [" ".join(f"w{i}" for i in range(80)) + f" end{k % 3}" for k in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    before = {n: stored_tables(spark, n) for n in ("buckets", "candidate-texts")}
    classes, links = near_dedup.near_duplicates(docs)
    assert {r.class_id for r in classes.collect()} == {0}
    digests = {hashlib.md5(t.encode()).hexdigest() for t in texts}
    assert {x for r in links.collect() for x in (r.u, r.v)} == digests
    buckets, *fetched = (stored_tables(spark, n) - old for n, old in before.items())
    assert {f.dataType.simpleString() for p in buckets for f in spark.read.parquet(p).schema} == {"bigint"}
    assert all(spark.read.parquet(p).count() <= 3 for p in fetched[0])
    assert fetched[0]


def test_bits_of_draws_keep_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(200):
        one = rng.integers(0, 1 << 32, near_dedup.FINE, np.uint64).astype(np.uint32)
        unlike = rng.integers(0, 1 << 32, near_dedup.FINE, np.uint64).astype(np.uint32)
        other = np.where(rng.random(near_dedup.FINE) < (0.8 if k < 100 else 0.5), one, unlike)
        packed = [np.packbits(near_dedup._folded(x[None], 1).astype(np.uint8), axis=1).view(np.int64)[0].tolist() for x in (one, other)]
        rows.append((k, *packed))
    told = spark.createDataFrame(rows, "k int, a_fine array<bigint>, b_fine array<bigint>")
    kept = {r.k for r in told.where(near_dedup._still_promising(0.8)).collect()}
    assert len(kept & set(range(100))) >= 98 and len(kept & set(range(100, 200))) <= 2


def test_copies_are_put_into_buckets_once(spark):
    """Copies that different tasks read make no further rows, and texts are fetched in place of sets."""
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text + (" end" if i % 5 == 0 else "")) for i in range(40)], "doc_id bigint, text string").repartition(4)
    before = {n: stored_tables(spark, n) for n in ("buckets", "shingle-sets")}
    out, _ = parity_join.jaccard_links(docs)
    assert {r.component_id for r in out.collect()} == {0}
    buckets, sets = (stored_tables(spark, n) - old for n, old in before.items())
    assert not sets and len(buckets) == 1
    told = spark.read.parquet(*buckets)
    assert 0 < told.count() == told.distinct().count()


def test_nodes_of_different_classes_meet_once(spark, monkeypatch):
    """Nodes that share all their buckets are compared in one of them, by lanes."""
    monkeypatch.setattr(near_dedup, "LANE", 3)
    n, planes = 20, [f"{c} array<bigint>" for c in near_dedup._planes()]
    rng = np.random.default_rng(8)
    bits = rng.integers(-(1 << 62), 1 << 62, (near_dedup.PLANES, near_dedup.FINE // 64))
    nodes = spark.createDataFrame(
        [(i, 1.0, [1] * 36, list(range(12))) for i in range(n)], "id bigint, mass double, draws array<tinyint>, keys array<bigint>"
    )
    told = spark.createDataFrame([(k, i, i % 10, n) for k in range(12) for i in range(n)], "key bigint, id bigint, root bigint, n bigint")
    rows = [(i, *bits.tolist()) for i in range(n)]
    fine = spark.createDataFrame(rows, ", ".join(["id bigint", *planes]))
    got = [tuple(r) for r in near_dedup._pairs_across(told, nodes, fine, 0.8).collect()]
    assert len(got) == len(set(got))
    assert {tuple(sorted(p)) for p in got} == {(b, a) for a in range(n) for b in range(a) if a % 10 != b % 10}


def test_all_bits_of_draws_keep_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(4)

    def planes(x):
        bits = near_dedup._folded(x[None], near_dedup.PLANES)
        return [np.packbits((bits >> (near_dedup.PLANES - 1 - p) & 1).astype(np.uint8), axis=1).view(np.int64)[0].tolist() for p in range(near_dedup.PLANES)]

    rows = []
    for k in range(200):
        one, unlike = rng.integers(0, 1 << 32, (2, near_dedup.FINE), np.uint64).astype(np.uint32)
        other = np.where(rng.random(near_dedup.FINE) < (0.8 if k < 100 else 0.66), one, unlike)
        rows.append((k, *planes(one), *planes(other)))
    names = [*near_dedup._planes("a_"), *near_dedup._planes("b_")]
    told = spark.createDataFrame(rows, ", ".join(["k int", *(f"{c} array<bigint>" for c in names)]))
    kept = {r.k for r in told.where(near_dedup._finely_promising(0.8)).collect()}
    assert len(kept & set(range(100))) >= 99 and len(kept & set(range(100, 200))) <= 3


def test_rounds_broadcast_nothing(spark, monkeypatch):
    """No side of a round of near-dedup or of components goes through the driver, however small; marks and results apart."""
    plans = []

    def keep(module):
        write = module.stored

        def stored(df, name):
            plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
            return write(df, name)

        monkeypatch.setattr(module, "stored", stored)

    keep(near_dedup)
    keep(components)
    texts = [" ".join(f"w{i}" for i in range(80)) + f" end{k % 3}" for k in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    assert {r.class_id for r in near_dedup.near_duplicates(docs)[0].collect()} == {0}
    rounds = {"edges", "links", "open-buckets", "first-pairs", "further-pairs"}
    assert rounds <= {name for name, _ in plans}
    assert not [name for name, plan in plans if name in rounds and "Broadcast" in plan]
