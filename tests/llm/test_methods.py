"""Operators against brute force, exact round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from staylens.llm import (
    components,
    decontamination,
    extraction,
    fingerprints,
    language,
    near_dedup,
    packing,
    quality,
    toxicity,
    warc,
    words,
)
from staylens.llm.labels import labelled_sample
from staylens.llm.oracles import ORACLES
from staylens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def word_list(text: str) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return WORD.findall(lower)


def shingle_set(text: str, n: int = 5) -> Counter:
    w = word_list(text)
    return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, min(len(w), 1))))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    want = sorted(map(repr, (tuple(dict(zip(columns, r, strict=True))[c] for c in sorted(columns)) for r in result.fetchall())))
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in df.select(*sorted(columns)).collect()) == want


def test_word_hashes_are_of_the_words(monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abC9é .,\n") for _ in range(rng.randrange(60))) for _ in range(200)] + ["x" * 500]
    for piece in (words.PIECE, 64):  # small pieces cut the buffer at every turn
        monkeypatch.setattr(words, "PIECE", piece)
        hashes, starts = words.word_hashes(*words.text_buffer(pa.array(texts)))
        assert np.diff(starts).tolist() == [len(word_list(t)) for t in texts]
        names = [w for t in texts for w in word_list(t)]
        assert len(set(names)) == len(set(hashes.tolist())) == len(set(zip(names, hashes.tolist(), strict=True)))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"s{i}") for i in range(80)] + [("a", "a"), ("x", "y"), ("y", "x")]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    want = {**{f"c{i:03}": "c000" for i in range(61)}, "hub": "hub", **{f"s{i}": "hub" for i in range(80)}, "x": "x", "y": "x"}
    assert got == want
    assert components.components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_components_of_two_edge_tables(spark):
    """Classes that are found already, and further edges among their roots, members and new nodes."""
    rng, kind = random.Random(6), "u bigint, v bigint"
    first, more = ([(rng.randrange(300), rng.randrange(300)) for _ in range(n)] for n in (150, 60))
    root = list(range(300))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    found = None
    for edges in (first, more, more[:5]):
        for u, v in edges:
            root[max(top(u), top(v))] = min(top(u), top(v))
        found = components.merged(spark.createDataFrame(edges, kind).repartition(5), found)
        assert sorted((r.node, r.root) for r in found.collect()) == [(x, top(x)) for x in range(300) if top(x) != x]
    chain = spark.createDataFrame([(x + 1, x) for x in range(100)] + [(200, 150)], "node bigint, root bigint")
    got = {r.node: r.root for r in components.flattened(chain.repartition(3)).collect()}
    assert got == {**{x + 1: 0 for x in range(100)}, 200: 150}


def test_components_take_few_shuffles(spark, monkeypatch):
    """Each shuffle is a stage of as many tasks as there are shuffle partitions, of which the driver keeps books, however few edges."""
    plans, write = [], components.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(components, "stored", stored)
    star = spark.createDataFrame([(x, 0) for x in range(1, 200)], "u bigint, v bigint").repartition(4)
    assert components.components(star).count() == 200
    assert sum(p.count("Exchange hashpartitioning") for p in plans) <= 8


def test_kept_documents_take_one_pass_over_classes(spark, monkeypatch):
    """Ids that repeat or are NULL, in classes of several texts: one row a class is kept, by one join of rows with classes."""
    plans, write = {}, near_dedup.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(near_dedup, "stored", stored)
    long = " ".join(f"w{i}" for i in range(90))
    rows = [(7, long), (3, f"{long} end"), (3, f"{long} close"), (None, long), (None, "alone here"), (None, "alone here"), (5, None), (4, "")]
    kept = near_dedup.without_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept) == [(0, "alone"), (3, "w0 w1"), (4, "")]
    assert plans["kept"].count("Join") == 1


def test_draws_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(1)
    shingles = np.sort(rng.integers(1, 1 << 48, 80, dtype=np.uint64))
    one = rng.uniform(0.5, 3, 80).astype(np.float32)
    other = one.copy()
    other[:30] = rng.uniform(0.5, 3, 30)
    owner = np.zeros(80, np.int64)
    a, b = (near_dedup.draws(owner, shingles, w, 4000)[1] for w in (one, other))
    assert abs((a == b).mean() - np.minimum(one, other).sum() / np.maximum(one, other).sum()) < 0.03


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    """Pairs, chains of edits, exact copies and unlike texts that share a passage."""
    monkeypatch.setattr(near_dedup, "HUB_HASHES", 1)  # two hubs a bucket, so that the last step has work to do
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    texts = []
    for _ in range(40):
        texts.append(passage + " " + " ".join(rng.choices(vocabulary, k=60)))
    for base in texts[:12]:
        w = base.split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    chain = rng.choices(vocabulary, k=120)
    for step in range(40):
        chain[(step * 29) % 120] = f"step{step}"
        texts.append(" ".join(chain))
    texts += texts[:3] + [texts[-1]] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    classes, links = near_dedup.near_duplicates(docs)
    got = {r.doc_id: r.class_id for r in classes.collect()}

    idf = near_dedup.document_frequencies(docs)
    sets = [near_dedup.weighted_set(t, idf) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_dedup.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i in range(len(texts))}
    assert all(r.similarity >= 0.8 for r in links.collect())
    kept = near_dedup.without_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_exact_and_near_matches_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 10)  # several blocks of items
    rng = random.Random(9)
    vocabulary = list("abcdefgh")
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(60)] + [None, ""]
    items = [(n, " ".join(rng.choices(vocabulary, k=rng.randrange(7)))) for n in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table = spark.createDataFrame(items, "item_id bigint, text string")
    index = decontamination.build_index(docs)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontamination.contamination(index, table, 4).collect()}
    near = {(r.doc_id, r.item_id, r.start) for r in decontamination.near_matches(index, table, 4, 2).collect()}
    for d, text in enumerate(texts):
        w, hit, found = word_list(text or ""), set(), set()
        for item, phrase in items:
            p = word_list(phrase)
            for k in range(max(len(p) - 3, min(len(p), 1))):
                window = p[k : k + 4]
                for s in range(len(w)):
                    if w[s : s + len(window)] == window:
                        hit |= set(range(s, s + len(window)))
                        found.add(str(item))
                    if w[s] in window and set(window) <= set(w[s : s + len(window) + 2]):
                        assert (d, item, s) in near
                        near.discard((d, item, s, 0))
        assert got[d] == (len(w), len(hit), sorted(found))
    for d, item, s in near:
        p, w = word_list(dict(items)[item]), word_list(texts[d])
        spans = [p[k : k + 4] for k in range(max(len(p) - 3, 1))]
        assert any(w[s] in x and set(x) <= set(w[s : s + len(x) + 2]) for x in spans)


def test_fingerprints_against_exact_sets(spark, documents):
    out = {r.doc_id: r for r in fingerprints.fingerprint_edits(documents).collect()}
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    errors = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        changed = text[: len(text) - q] + after[:q]
        r = out[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        sets = [set(x) for x in (Counter(), Counter())]
        sets = [{tuple(s) for s in shingle_set(t.lower())} for t in (text, changed)]
        exact = len(sets[0] & sets[1]) / max(len(sets[0] | sets[1]), 1)
        if max(map(len, sets)) <= fingerprints.FLOOR:  # kept whole: no estimate
            assert abs(r.near_edited - exact) < 1e-9
        errors.append(abs(r.near_edited - exact))
    assert max(errors) < 0.25 and sum(errors) / len(errors) < 0.04


def test_packing_round_trip(spark, documents):
    """Every piece's checksum is that of the public tokenizer's ids; sequences have no gap and hardly any padding."""
    rows = packing.pack(documents, path("byte_bpe_50k.json")).collect()
    public = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces: dict = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc in documents.collect():
        ids = np.array([*public.encode(doc.text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sums = Counter()
    for r in rows:
        sums[r.sequence_id] += r.length
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sums.values())
    assert max(sums.values()) <= 2048 and padding < 0.005 * sum(sums.values())


def test_ids_of_unusual_texts():
    ours, public = packing.tokenizer(path("byte_bpe_50k.json")), Tokenizer.from_file(path("byte_bpe_50k.json"))
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["a", "the", "é", "9", " ", " ", "\n", "\t", "  ", "'s", "!", "東", " ", "\r"]) for _ in range(rng.randrange(25)))
        assert ours.ids(text).tolist() == public.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_inside_texts(spark):
    vocabulary = path("byte_bpe_50k.json")
    ours, public = packing.tokenizer(vocabulary), Tokenizer.from_file(vocabulary)
    assert ours.ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    rng, texts = random.Random(3), []
    for _ in range(400):
        texts.append("".join(rng.choice(["<|endoftext|>", "<|endof", "text|>", "<|", "a", " the", " ", "\n", "\t", "é"]) for _ in range(rng.randrange(15))))
        assert ours.ids(texts[-1]).tolist() == public.encode(texts[-1], add_special_tokens=False).ids, repr(texts[-1])
    texts += ["word <|endoftext|> " * 3000]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), vocabulary).collect()
    found: dict = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    for k, text in enumerate(texts):
        ids, at = np.array([*public.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(found[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("seed", range(3))
def test_plans_place_every_remainder_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(3, 1, 3000).astype(int) + 1, 127)
    counts = np.bincount(lengths, minlength=128)
    made = packing.plan(counts, 128, 60)
    filled = Counter()
    covered = {(int(n), r): 0 for n in range(128) for r in range(counts[n])}
    for length, first, stop, base, each, offset in made.runs.tolist():
        for r in range(first, stop):
            k = r - first
            covered[length, r] += length
            start = offset + k % each * length
            filled.update((base + k // each, p) for p in range(start, start + length))
    for length, first, stop, _ in made.tails.tolist():
        for rank in range(first, stop):
            for _, size, sequence, offset in made.cut(length, rank):
                covered[length, rank] += size
                filled.update((sequence, p) for p in range(offset, offset + size))
    assert all(n == length for (length, _), n in covered.items())
    assert set(filled.values()) == {1} and max(p for _, p in filled) < 128
    assert made.sequences <= np.ceil((np.arange(128) * counts).sum() / 128) + 8


@pytest.mark.parametrize("lengths", [[1500], [1025, 1026], list(range(1100, 1900))])
@pytest.mark.parametrize("total", [1_000, 1_000_000, 1_000_000_000])
def test_padding_does_not_grow_with_the_corpus(lengths, total):
    counts = np.zeros(packing.CAPACITY, np.int64)
    counts[lengths] = -(-total // len(lengths))
    made = packing.plan(counts)
    ids = int((np.arange(packing.CAPACITY) * counts).sum())
    assert ids <= made.sequences * packing.CAPACITY <= 1.01 * ids + 12 * packing.CAPACITY
    assert len(made.runs) + len(made.tails) + len(made.places) < 4 * packing.CAPACITY
    length, first, stop, _ = made.tails[-1].tolist()
    for rank in (first, stop - 1):
        assert sum(size for _, size, _, _ in made.cut(length, rank)) == length


def test_packing_where_no_two_documents_fit(spark):
    vocabulary = path("byte_bpe_50k.json")
    texts = ["a b c d e f g h i j " * 60 + str(k % 40) for k in range(400)]  # 40 texts of one length, each ten times
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), vocabulary, 1024).collect()
    ours, filled, pieces = packing.tokenizer(vocabulary), Counter(), {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        filled.update((r.sequence_id, p) for p in range(r.offset, r.offset + r.length))
    for k, text in enumerate(texts):
        ids, at = np.append(ours.ids(text), 1).astype("<u4"), 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    used = Counter(s for s, _ in filled)
    assert set(filled.values()) == {1} and sorted(used) == list(range(len(used)))
    assert all(max(p for s, p in filled if s == k) == used[k] - 1 for k in list(used)[:20])
    assert 1024 * len(used) <= 1.05 * sum(used.values())


def test_classifiers_on_the_held_out_fold(spark):
    base = "/root/testdata/sf0.1"  # 825 held-out labels; the smaller tables have 70 and fewer
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r for r in labels.collect()}
    rows = [r for r in quality.predictions(docs, labels).collect() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id].quality for r in rows) >= 0.98 * len(rows)
    model = toxicity.train(docs, labels)
    out = {r.doc_id: r for r in toxicity.predictions(docs, labels).collect()}
    rows = [r for r in out.values() if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id].toxic for r in rows) >= 0.96 * len(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = [texts[i] for i in sorted(known) if known[i].toxic == 0 and texts.get(i)]
    long = "\n".join(clean * (1 + 1_000_000 // sum(map(len, clean))))[:1_000_000]
    assert model.score(long)[0] < 0.5 and model.score(" ".join(re.findall(r"\w+", long)))[0] < 0.5
    worst = max((i for i in known if known[i].toxic), key=lambda i: out[i].worst_score)
    assert model.score(f"{long[:200_000]}\n{texts[worst]}\n{long[200_000:400_000]}")[0] >= 0.5
    found = toxicity.offending_sentences(docs, model).collect()
    assert found and all(texts[r.doc_id][r.start : r.start + r.length] == r.sentence and r.score >= 0.5 for r in found)
    told = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.predictions(docs).collect() if r.held_out]
    assert sum(r.lang_pred == told[r.doc_id] for r in rows) >= 0.99 * len(rows)


def test_flattened_trees_are_walked_like_nodes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(int)
    model = quality.fit(x, y, trees=30, depth=3)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    for row in x[:20]:
        margin = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert abs(model.score(row[None])[0] - 1 / (1 + np.exp(-margin))) < 1e-12


def test_noisy_or_finds_the_sentence():
    rng = random.Random(1)
    plain = [f"plain{i}" for i in range(50)]

    def text(bad):
        sentences = [" ".join(rng.choices(plain, k=8)) for _ in range(6)]
        if bad:
            sentences[rng.randrange(6)] += " vileness"
        return ". ".join(sentences) + "."

    y = [i % 4 == 0 for i in range(200)]
    model = toxicity.fit([text(b) for b in y], y)
    score, start, length, worst = model.score("plain1 plain2. Such vilenesses here! plain3.")
    assert score > 0.5 and worst > 0.5 and "vilenesses" in "plain1 plain2. Such vilenesses here! plain3."[start : start + length]
    assert model.score(text(False))[0] < 0.3
    assert model.score("plain1 plain2. " * 100_000)[0] < 0.3 and model.score("plain1 plain2 " * 100_000)[0] < 0.3


def test_stretches_cover_texts_with_and_without_stops():
    words = [f"w{i}" for i in range(2 * toxicity.STRETCH + 5)]
    found = list(toxicity.stretches(" ".join(words)))
    assert [len(w) for _, _, w in found] == [toxicity.STRETCH, toxicity.STRETCH, 5] and sum((w for *_, w in found), []) == words
    assert [a for a, _, _ in found][1:] == [b for _, b, _ in found][:-1]
    assert [w for *_, w in toxicity.stretches("一 二。三 四！अ आ। ... \u2028x")] == [["一", "二"], ["三", "四"], ["अ", "आ"], ["x"]]
    assert list(toxicity.stretches("")) == list(toxicity.stretches(" .!?")) == []


def test_extraction_by_host(spark):
    def page(body, extra=""):
        return (
            "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class='has-sidebar'>"
            "<header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
            f"<div class='layout1'><div class='story42'>{body}</div><div class='links'>{extra}</div></div>"
            "<div id='comments'><p>first comment, rather long and wordy, from a reader of this page</p></div>"
            "<aside>aside</aside><form><p>form</p></form><footer>&copy; x</footer><script>var a='<p>no</p>'</script></body></html>"
        )

    body = "<h1>Title &amp; more</h1><p>One  <b>two</b>\n three.<p>Four&nbsp;five<br>six.<ul><li>a<li>b</ul><!-- c --><div class='ad'>buy</div>"
    long_extra = "<p>" + "other words in the page " * 9 + "</p>"
    rows = [(i, f"https://H.example/{i}", page(body + f"<p>{i} {'text ' * 30}</p>")) for i in range(5)]
    rows += [(9, "https://h.example/9", page(body, long_extra)), (10, "https://other.example/", "<p>plain page</p>"), (11, None, "no markup at all")]
    out = {r.page_id: r for r in extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    lead = "Title & more\nOne two three.\nFour five six.\na\nb"
    assert out[0].text == lead + "\n0 " + ("text " * 30).strip()
    assert out[9].text == lead  # the host's path, though most words of this page stand elsewhere
    assert out[10].text == "plain page" and out[11].text == "no markup at all"
    assert out[0].path == out[9].path == "html>body.hassidebar>div.layout>div.story"


@pytest.mark.parametrize(
    "wrapper",
    ["div class='row with-sidebar'", "div id='page' class='has-comments'", "section class='search-result-page'", "div role='banner'"],
)
def test_wrapper_named_after_a_part_keeps_the_article(wrapper):
    story = "<h1>Title</h1>" + "<p>some running text</p>" * 9
    parts = "<div class='sidebar'><p>side</p></div><div id='comments'><article class='comment'><p>first comment</p></article></div>"
    want = "\n".join(["Title", *["some running text"] * 9])
    for inner in (f"<article>{story}</article>", f"<main>{story}</main>", f"<div class='story'>{story}</div>"):
        page = f"<html><body><{wrapper}>{inner}{parts}</{wrapper.split()[0]}></body></html>"
        assert extraction.Page(page).text(None) == want


def test_small_article_saves_its_wrapper_but_no_teasers():
    extra = "<div class='other'>" + "<p>words of the template</p>" * 9 + "</div>"
    page = f"<body><div class='search-page'><article><p>the short article</p></article></div>{extra}</body>"
    assert "the short article" in extraction.Page(page).blocks
    teasers = "<div class='related'><article><p>a teaser</p></article></div>"
    assert extraction.Page(f"<body><article><p>{'text ' * 30}</p></article>{teasers}</body>").blocks == [("text " * 30).strip()]


def test_inner_container_never_wins_over_text_it_leaves_out(spark):
    body = "<p>" + "running text " * 400 + "</p>"
    linked = "<p>see <a href='/x'>this other page and its many links</a></p>"
    for around in ("<div class='content'><h1>{0}</h1><div class='body'>{1}</div>{2}</div>", "<h1>{0}</h1><div class='body'>{1}</div>{2}"):
        for page in (f"<body>{around}</body>", around):
            page = page.format("Headline", body, linked)
            assert extraction.Page(page).text(None).splitlines() == ["Headline", ("running text " * 400).strip(), "see this other page and its many links"]
    inner = extraction.Page(f"<body><div class='content'><div class='body'>{body}</div></div></body>").best()
    assert inner[0] == "body>div.content>div.body"  # nothing stands outside
    page = "<body><div class='content'><h1>Headline</h1><div class='body'>" + body + "</div></div></body>"
    rows = [(i, f"https://h.example/{i}", page) for i in range(3)]
    out = extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r.text.startswith("Headline\n") for r in out)


def test_hidden_text_stays_and_inline_parts_go():
    page = "<body><article><p>one <span class='ad'>buy</span> two</p><p hidden>three</p><p style='display: none'>four</p></article></body>"
    assert extraction.Page(page).text(None) == "one two\nthree\nfour"


def test_formulas_fallbacks_and_headlines_stay():
    page = "<body><article><h1 class='post-share'>Headline</h1><p>x<math><mi>a</mi>+b</math>y</p><noscript><p>kept</p></noscript></article></body>"
    assert extraction.Page(page).text(None) == "Headline\nxa+by\nkept"


@pytest.mark.parametrize("tag", ["div", "div class='ad'", "fieldset", "span", "li"])
def test_deep_pages_take_linear_memory(tag):
    import tracemalloc

    peaks = []
    for n in (2_000, 20_000):
        page = f"<html><body><{tag}>x " * n
        tracemalloc.start()
        read = extraction.Page(page)
        assert read.text(read.best()[0]).split()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 15 * peaks[0]


def test_votes_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        story, side = rng.choice(["story1", "story2", "text"]), "<p>side words</p>" * rng.randrange(3)
        rows.append((i, f"https://h{i % 4}.example/{i}", f"<body><div class='{story}'>{'<p>running text</p>' * 5}</div>{side}</body>"))
    votes = {}
    for _, url, html in rows:
        path, score = extraction.Page(html).best()
        host = votes.setdefault(url.split("/")[2], Counter())
        host[path] += round(score * 1000)
    want = {h: max(v, key=lambda p: (v[p], -len(p), p)) for h, v in votes.items()}
    out = extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(out) == 60
    for r in out:
        assert r.path == want[r.url.split("/")[2]] and r.text == extraction.Page(rows[r.page_id][2]).text(r.path)


def _archive(records):
    import gzip

    return [gzip.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") for head, block in records]


def test_foreign_archives(spark, tmp_path):
    def head(kind, block, *more):
        return [["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", f"Content-Length: {len(block)}", *more], block]

    answer = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>one</p>"
    members = _archive(
        [
            head("warcinfo", b"software: other"),
            head("request", b"GET / HTTP/1.1\r\n\r\n"),
            head("response", answer, "WARC-Target-URI: https://x.example/"),
            head("resource", b"plain", "WARC-Payload-Digest: sha256:00"),
            head("response", answer, "WARC-Payload-Digest: sha1:" + "A" * 32),
            [["WARC/1.0", "WARC-Type: response", "Content-Length: many"], b""],
            head("revisit", b"", "WARC-Payload-Digest: sha1:" + "0" * 40),
        ]
    )
    broken = bytearray(_archive([head("response", b"noise " + bytes(random.Random(1).randbytes(5_000)))])[0])
    broken[2_000:2_040] = b"\xff" * 40
    data = b"".join([*members[:3], bytes(broken), *members[3:]])
    (tmp_path / "other.warc.gz").write_bytes(data)
    manifest = spark.createDataFrame([("other.warc.gz", len(data))], "file string, bytes bigint")
    for size in (1 << 20, 97):
        rows = warc.read_archives(manifest, f"file://{tmp_path}", range_bytes=size).collect()
        good = sorted((r.record_type, r.payload and bytes(r.payload), r.payload_bytes) for r in rows if r.error is None)
        assert good == [("resource", b"plain", 5), ("response", b"<p>one</p>", 10), ("revisit", None, None)]
        errors = [r.error for r in rows if r.error is not None]
        assert len(errors) == 3 and all(e.startswith("other.warc.gz, byte ") for e in errors)
    with pytest.raises(Exception, match="other.warc.gz, byte"):
        warc.read_archives(manifest, f"file://{tmp_path}", mode="FAILFAST").collect()
    assert warc.opened("/tmp/x")[1] == "/tmp/x"


def test_archives_read_by_any_ranges(spark):
    given = spark.read.parquet(f"{SF}/pages.parquet")
    manifest, folder = warc.write_archives(given, file_bytes=40_000)
    whole = {r.page_id: bytes(r.payload) for r in warc.read_archives(manifest, folder).collect()}
    assert whole == {r.page_id: r.html.encode() for r in given.collect()}
    for size in (700, 5_000):
        rows = warc.read_archives(manifest, folder, range_bytes=size).collect()
        assert len(rows) == len(whole) and {r.page_id: bytes(r.payload) for r in rows} == whole


def test_gzip_magic_inside_a_payload_starts_no_record():
    import io

    payload = warc.MAGIC + bytes(random.Random(5).randbytes(3000)) + warc.MAGIC * 9
    made = [warc.record(i, "u", payload + bytes([i]), hashlib.sha1(payload + bytes([i])).hexdigest(), None) for i in range(4)]
    data = b"".join(made)
    starts = [sum(map(len, made[:i])) for i in range(4)]
    for cut in (1, 100, len(made[0]), len(data) // 2):
        parts = [p for a, b in ((0, cut), (cut, len(data))) for p, _ in warc.records_in_range(io.BytesIO(data), len(data), a, b)]
        assert parts == starts


def test_classifiers_hold_no_whole_texts_on_the_driver(spark, monkeypatch):
    """Quality: the driver gets statistics, the same as of the texts.  Language: counts of a text in short numbers."""
    docs = spark.createDataFrame([(i, f"Word {i}. " * (i % 7) or None) for i in range(60)], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    seen, given = [], []
    whole = type(docs).toPandas
    monkeypatch.setattr(type(docs), "toPandas", lambda df: seen.append(df.columns) or whole(df))
    monkeypatch.setattr(quality, "fit", lambda x, y: given.append((x, y)))
    quality.train(docs, labels)
    assert seen and all("text" not in columns for columns in seen)
    texts, y = labelled_sample(docs, labels, "quality")
    assert (given[0][0] == quality.statistics(pa.array(texts, pa.large_string()))).all() and given[0][1].tolist() == y

    text, idf = "some words of a text " * 9, np.linspace(0.5, 2, language.WIDTH).astype(np.float32)
    bins, counts = language.counted(text)
    assert bins.nbytes + counts.nbytes <= 4 * len(bins)
    of_text = language.ngrams(text)
    values = (1 + np.log(of_text[bins])) * idf[bins]
    assert (language.vector(text, idf)[1] == values / np.sqrt((values**2).sum())).all()
