"""The ten operators and the pipeline on small tables, against brute force, and with awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import (decontaminate, exact, mixing, ngram_join, packing, page_text, passages, pii, token_matrix, tokens,
                          toxicity)
from tidemark.llm.components import components
from tidemark.llm.words import Words

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000)) + "."
PASSAGE = " ".join(f"pass{i}" for i in range(60)) + "."
AWKWARD = [
    (1, "Plain text, nothing more."), (1, "Plain text, nothing more."), (2, None), (3, ""), (4, " \t\n "), (None, "No id here."),
    (None, None), (5, LONG), (6, LONG + " "), (7, "Plain text,\nnothing more."), (8, f"Before it. {PASSAGE} After it."),
    (9, f"Elsewhere.\n{PASSAGE}\nOther end."), (10, "a.b@c.example.org call +1 (555) 555-0100 card 4111 1111 1111 1111 at 10.20.30.40"),
    (11, "x" * 200_000), (12, "é" * 3 + " ß <|endoftext|> don't 12"),
]
SCHEMA = "doc_id long, text string, kept int, row string, score double, `n` int, tiles int, component_id string"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(i, t, 1, "r", 0.5, 7, 3, "c") for i, t in AWKWARD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_words_do_not_depend_on_place():
    a, b = Words([b"One two  THREE", b"three one"]), Words([b"x" * 70, b"two\tone three"])
    assert a.numbers[0] == a.numbers[4] == b.numbers[2]
    assert a.numbers[2] == a.numbers[3] == b.numbers[3]
    assert a.first.tolist() == [0, 3, 5]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_words_split_like_bytes(texts):
    raw = [t.encode() for t in texts]
    words = Words(raw)
    assert np.diff(words.first).tolist() == [len(r.split()) for r in raw]
    seen = {}
    for number, word in zip(words.numbers.tolist(), [w for r in raw for w in r.lower().split()], strict=True):
        assert seen.setdefault(word, number) == number


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 80), (7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect())
    assert got == {i: 0 for i in range(41)} | {100: 80, 90: 80, 80: 80}


# 1 and 5: ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abTHE'sStldéÉß×.,!?-<|>1 \n\t\xa0İΣ"), st.characters(exclude_categories=["Cs"]))))
def test_ids_equal_the_tokenizer(text):
    encoder = test_ids_equal_the_tokenizer.__dict__.setdefault("encoder", tokens.Encoder(tokens.default_path()))
    ids, _ = encoder.encode(Words([text.encode()]))
    assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def expected_ids(docs):
    encoder = tokens.Encoder(tokens.default_path()).tokenizer
    return sorted(((d, tuple(encoder.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in docs),
                  key=lambda x: (x[0] is None, x))


def test_token_matrix_round_trip(awkward, empty):
    found = collections.defaultdict(list)
    for r in token_matrix.token_matrix(awkward).collect():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 4096 and not ids[r.n_ids:].any()
        assert r.cumulative_lengths[-1] == r.n_ids and r.resets == r.cumulative_lengths[:-1]
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cumulative_lengths, r.cumulative_lengths[1:], strict=False):
            found[d, s].append(ids[a:b].tolist())
    for _, ids in expected_ids(AWKWARD):
        pass
    by_doc = collections.Counter()
    for (d, _), parts in found.items():
        by_doc[d] += sum(map(len, parts))
    want = collections.Counter()
    for d, ids in expected_ids(AWKWARD):
        want[d] += len(ids)
    assert by_doc == want
    whole = {d: ids for d, ids in expected_ids(AWKWARD) if d in (5, 12)}
    for d, ids in whole.items():
        assert sum((found[k][0] for k in sorted(k for k in found if k[0] == d)), []) == list(ids)
    assert token_matrix.token_matrix(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(sizes):
    bins = token_matrix.best_fit_decreasing(np.array(sizes, dtype=np.int64), 50)
    assert sorted(p for b in bins for p in b) == list(range(len(sizes)))
    rooms = []
    for size in sorted(sizes, reverse=True):  # the same by looking at every bin
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms[rooms.index(min(fits))] -= size
        else:
            rooms.append(50 - size)
    assert sorted(50 - sum(sizes[p] for p in b) for b in bins) == sorted(rooms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 5)), min_size=1, max_size=30))
def test_best_cuts_cost_least(steps):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalties = np.array([0] + [p for _, p in steps], dtype=float)
    window = 12
    best = [0.0] + [math.inf] * len(steps)
    for j in range(1, len(places)):
        for i in range(j):
            if places[j] - places[i] <= window:
                best[j] = min(best[j], best[i] + window - (places[j] - places[i]) + penalties[j])
    cuts = packing.best_cuts(places, penalties, window)
    edges = [0, *cuts]
    assert all(places[b] - places[a] <= window for a, b in zip(edges, edges[1:], strict=False))
    cost = sum(window - (places[b] - places[a]) + penalties[b] for a, b in zip(edges, edges[1:], strict=False))
    assert cost == pytest.approx(best[-1])


def check_pieces(rows, docs):
    want = collections.Counter(ids for _, ids in expected_ids(docs))
    del want
    total = collections.Counter()
    for d, ids in expected_ids(docs):
        total[d] += len(ids)
    got, sequences = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == total
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    ids_of = {d: np.array(ids, "<u4") for d, ids in expected_ids(docs)}
    repeated = {d for d, n in collections.Counter(d for d, _ in docs).items() if n > 1}
    for r in rows:
        if r["doc_id"] not in repeated:
            ids = ids_of[r["doc_id"]]
            assert r["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"]


def test_packing(awkward, empty, documents):
    check_pieces(rows_of(packing.pack_in_order(awkward)), AWKWARD)
    rows = rows_of(packing.pack_in_order(documents.coalesce(1)))
    check_pieces(rows, [(r.doc_id, r.text) for r in documents.collect()])
    used = len({r["sequence_id"] for r in rows})
    assert sum(r["length"] for r in rows) > 4096 * (used - 1) * 0.97
    assert packing.pack_in_order(empty).count() == 0


# 2: pages

SHELL = ('<html><head><title>T {i}</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>'
         '<div class="ad">Buy {i}</div><div class="c1"><h1>Title {i}</h1><p>First &amp; <b>bold</b>ly {i}\n text.<br>more<p>{body}</div>'
         '<div class="comments"><p>Nice! {i}</p></div><form><p>Name</p></form><footer>&copy; site</footer></body></html>')


def test_page_text(spark):
    bodies = [" ".join(f"w{i}-{k}" for k in range(30)) for i in range(6)]
    pages = [(i, f"http://one.example/p{i}", SHELL.format(i=i, body=b)) for i, b in enumerate(bodies)]
    pages += [(10, "http://two.example/", "<p>Only &lt;this&gt;</p>"), (11, None, None), (12, "x", ""), (None, "y", "plain < text"),
              (10, "http://two.example/", "<p>Only &lt;this&gt;</p>"), (13, "z", "<div " * 2000 + "<p>" * 500 + "end")]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, host string, text int")
    got = collections.defaultdict(list)
    for r in page_text.page_texts(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    for i, body in enumerate(bodies):
        assert got[i] == [f"Title {i}\nFirst & boldly {i} text. more\n{body}"]
    assert got[10] == ["Only <this>"] * 2 and got[11] == [""] and got[12] == [""] and got[None] == ["plain < text"]
    assert len(got[13]) == 1
    assert page_text.page_texts(df.limit(0)).count() == 0


# 3 and 6: passages and benchmark


def test_repeated_passages(awkward, empty):
    rows = rows_of(passages.repeated_passages(awkward))
    docs = {r["doc_id"] for r in rows}
    assert {8, 9} <= docs and not docs & {1, 2, 3, 4, 7, 10, 11, 12}
    assert {(r["doc_id"], r["keep_doc_id"], r["removed"]) for r in rows if r["doc_id"] in (8, 9)} == {(8, 8, False), (9, 8, True)}
    assert passages.repeated_passages(empty).count() == 0


def test_near_paragraphs_are_one_cluster(spark):
    base = [f"v{i}" for i in range(70)]
    changed = base[:]
    changed[40] = "other"
    docs = spark.createDataFrame([(1, " ".join(base) + "."), (2, " ".join(changed) + "."), (3, " ".join(base[::-1]) + ".")],
                                 "doc_id long, text string")
    rows = rows_of(passages.repeated_passages(docs))
    assert {(r["doc_id"], r["keep_doc_id"]) for r in rows} == {(1, 1), (2, 1)}
    bands, size = passages.bands_for()
    assert 1 - (1 - 0.8 ** size) ** bands >= 0.98


def test_overlaps(spark, awkward, empty, documents):
    item = [f"q{i}" for i in range(30)]
    changed = item[:]
    changed[7] = changed[18] = "swapped"
    docs = [(1, "Start " + " ".join(item).upper() + " end"), (2, "x y " + " ".join(changed)), (3, " ".join(item[:12])),
            (4, "what is it"), (5, " ".join(item[5:20])), (6, None), (None, " ".join(item))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, "What is IT"), (3, None), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.doc_word, r.item_word, r.n_words, r.n_same)
           for r in decontaminate.overlaps(frame, items).collect()}
    assert got == {(1, 1): (1, 0, 30, 30), (2, 1): (2, 0, 30, 28), (4, 2): (0, 0, 3, 3), (5, 1): (0, 5, 15, 15),
                   (None, 1): (0, 0, 30, 30)}
    assert decontaminate.overlaps(awkward, items.limit(0)).count() == 0
    assert decontaminate.overlaps(empty, items).count() == 0
    kept = decontaminate.without_overlaps(frame, items)
    assert {r.doc_id for r in kept.collect()} == {3, 6}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in documents.collect()]
    exact_hits = {(d, b.item_id) for b in bench.collect() for d, t in texts if b.text in t}
    assert exact_hits <= {(r.doc_id, r.item_id) for r in decontaminate.overlaps(documents, bench).collect()}


def test_equal_runs_at_any_place(spark):
    docs, passage = [], {}
    for k, (n, changed) in enumerate([(30, None), (33, None), (51, None), (60, None), (50, 20), (50, 25), (50, 29), (60, 30)]):
        words = [f"p{k}x{i}" + "." * (i % 6 == k % 6) for i in range(n)]
        for side in (0, 1):
            own = words[:]
            if side and changed is not None:
                own[changed] = "other"
            before = [f"a{k}x{side}x{i}" + "." * (i % (5 + k) == 2) for i in range(11 + 3 * k + 2 * side)]
            after = [f"z{k}x{side}x{i}" + "." * (i % 7 == side) for i in range(40)]
            docs.append((2 * k + side, " ".join(before + own + after)))
            passage[2 * k + side] = (len(before), n)
    rows = rows_of(passages.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: (r["start_word"], r["n_words"]) for r in rows} == passage and len(rows) == len(passage)
    assert all(r["removed"] == bool(r["doc_id"] % 2) and r["keep_doc_id"] == r["doc_id"] // 2 * 2 for r in rows)


def test_anchors_are_shared_by_equal_runs():
    rng = np.random.default_rng(5)
    for _ in range(200):
        run = [f"r{i}" for i in rng.integers(0, 9, 24)]
        sides = [Words([" ".join([*[f"{s}{i}" for i in range(rng.integers(0, 30))], *run, *[f"{s}{i}" for i in range(20)]]).encode()])
                 for s in "ab"]
        both = [set(w.shingles(passages.ANCHOR)[passages.anchors(w)].tolist()) for w in sides]
        assert both[0] & both[1]


def brute_overlap(same, least):
    return any(5 * sum(same[a:b]) >= 4 * (b - a) for a in range(len(same)) for b in range(a + least, len(same) + 1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([True, True, True, True, False]), min_size=1, max_size=45), min_size=1, max_size=4))
def test_every_aligned_run_is_found(lines):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(len(same)))) for i, same in enumerate(lines)]
    docs = ["before it " + " ".join(f"w{i}x{j}" if s else f"other{j}" for j, s in enumerate(same)) + " after it"
            for i, same in enumerate(lines)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs)), pa.int64()), pa.array(docs)], ["doc_id", "text"])
    rows = [r for out in decontaminate._overlaps(decontaminate.Seeds(items))([batch]) for r in out.to_pylist()]
    assert all(r["doc_id"] == r["item_id"] and r["n_same"] >= 0.8 * r["n_words"] for r in rows)
    want = {i for i, same in enumerate(lines) if brute_overlap(same, min(13, len(same)))}
    assert {r["doc_id"] for r in rows} == want
    for r in rows:
        same = lines[r["doc_id"]][r["item_word"]:r["item_word"] + r["n_words"]]
        assert (len(same), sum(same)) == (r["n_words"], r["n_same"]) and len(same) >= min(13, r["item_words"])


def test_run_around_a_shorter_one_with_as_large_a_score():
    same = [True] * 4 + [False] + [True] * 4 + [False] + [True] * 3
    assert decontaminate.best_run(np.array(same), 13) == (0, 13, 11)
    assert decontaminate.best_run(np.array(same[1:]), 13) is None


# 4: language model


def test_lm_scores(awkward, empty):
    rows = rows_of(mixing.lm_scores(awkward))
    words = [(d, (t or "").encode().lower().split() + [None]) for d, t in AWKWARD]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in AWKWARD}
    counts = collections.Counter(w for d, ws in words if d is not None and not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(d), len(ws), sum(counts[w] > 0 for w in ws),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 3)) for d, ws in words)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 3)) for r in rows) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 and r["held_out"] == held[r["doc_id"]] for r in rows)
    assert mixing.lm_scores(empty).count() == 0


def test_model_is_a_distribution():
    model = mixing.Model(np.random.default_rng(1).integers(-60, 60, mixing.SLOTS).astype(np.int8),
                         np.ones(mixing.SLOTS, np.int8), np.full((3, mixing.GATES, 4), 0.4))
    key = np.uint64(0x0161626320646500) & ~np.uint64(255)
    each = model.log_probabilities(key + np.arange(256, dtype=np.uint64))
    assert np.exp(each.astype(float)).sum(axis=1) == pytest.approx([1, 1, 1], abs=1e-4)


def test_tables_count_the_fold_of_the_mixers(spark):
    rows = [(1, "only here zebra quokka", 1), (2, "some other words", 2), (3, "some more words", 9), (4, "held out xylophone", 0)]
    model = mixing.train(spark.createDataFrame(rows, "doc_id long, text string, fold long"))

    def seen(text):
        keys, _ = mixing.grams([text.encode()])
        return model.sure[mixing.slots(mixing.contexts(keys), keys, 0)] > 0
    assert all(seen(text).all() for _, text, fold in rows if fold)
    assert not seen("held out xylophone").all()


def test_every_training_text_moves_weights_and_trust(spark):
    """No text of fold 1, and one late text by id that decides the trust: none of them is passed over."""
    plain = [(i, f"plain words number {i * 7919} and some more of them", 2 + i % 8) for i in range(40)]
    first = mixing.train(spark.createDataFrame(plain, "doc_id long, text string, fold long"))
    start = np.array(mixing.MIXERS)[:, None, None]
    assert (np.abs(first.weights - np.where(np.arange(4) < start, 1.2 / start, 0)).max(axis=(1, 2)) > 0.01).all()
    for fold in range(1, 10):
        more = mixing.train(spark.createDataFrame([*plain, (99, "abcdefghijklm" * 30, fold)], "doc_id long, text string, fold long"))
        assert not np.array_equal(more.weights, first.weights) and more.trust[-1] > first.trust[-1]


def test_repeats_and_blocks_of_many_texts(spark):
    texts = [b"", b"abcdefgh" * 40, b"a", b"xyz" * 200, b"abcdefgh" * 3]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    want = [(int(a) + at, run, true) for a, raw in zip(starts, texts, strict=False) for at, run, true in brute_repeats(raw)]
    assert list(zip(*[c.tolist() for c in mixing.repeats_of(texts)], strict=True)) == want
    model = mixing.Model(np.random.default_rng(1).integers(-60, 60, mixing.SLOTS).astype(np.int8),
                         np.ones(mixing.SLOTS, np.int8), np.full((3, mixing.GATES, 4), 0.4), np.linspace(0.2, 0.9, mixing.RUNS))
    assert model.scores(texts) == pytest.approx([model.scores([t])[0] for t in texts], rel=1e-6)


def brute_repeats(raw):
    data, out, run, seen = raw + bytes([mixing.END]), [], 0, {}
    for i in range(8, len(data)):
        context = data[i - 8:i]
        true = context in seen and data[seen[context]] == data[i]
        if context in seen:
            out.append((i, min(run.bit_length(), 6), true))
        run = run + 1 if true else 0
        seen[context] = i
    return out


def test_a_bit_is_predicted_once_for_equal_bytes_before_it(monkeypatch):
    """Neighbours that agree so far share a prediction, and grams met before ask for none; scores are those of each text alone."""
    rng, asked, inputs = np.random.default_rng(1), [], mixing.Model.inputs
    model = mixing.Model(rng.integers(-60, 60, mixing.SLOTS).astype(np.int8), rng.integers(0, 4, mixing.SLOTS).astype(np.int8),
                         rng.uniform(0, 0.6, (3, mixing.GATES, 4)), np.linspace(0.2, 0.9, mixing.RUNS))
    monkeypatch.setattr(mixing.Model, "inputs", lambda self, parts, keys, bit: asked.append(len(keys)) or inputs(self, parts, keys, bit))
    keys = np.uint64(0x0161626320646500) + np.arange(256, dtype=np.uint64)
    each = model.log_probabilities(keys)
    assert asked == [1, 2, 4, 8, 16, 32, 64, 128]
    mixed = rng.permutation(256)
    assert np.array_equal(model.log_probabilities(keys[mixed]), each[:, mixed])
    texts = [b"", b"abc abd", bytes(30), *[bytes(rng.integers(97, 105, n).tolist()) for n in (9, 200, 3000)]]
    want = [model.scores([text])[0] for text in texts]
    monkeypatch.setattr(mixing, "TOGETHER", 100)
    met = mixing.Met()
    assert model.scores(texts, met) == want
    asked.clear()
    assert model.scores(texts[::-1], met) == want[::-1] and sum(asked) < 100  # few grams meet another's place
    monkeypatch.setattr(mixing, "MET", 8)  # many grams for each place
    met = mixing.Met()
    for _ in range(2):
        assert model.scores(texts, met) == want


def test_repeats_in_a_text():
    rng = np.random.default_rng(5)
    texts = [b"", b"a", b"abcdefgh", b"a" * 9, b"a" * 100, *[bytes(rng.integers(97, 99, n).tolist()) for n in range(0, 300, 7)]]
    for raw in texts:
        at, run, true = mixing.repeats(raw)
        assert list(zip(at.tolist(), run.tolist(), true.tolist(), strict=True)) == brute_repeats(raw)


def test_repeats_keep_a_distribution():
    model = mixing.Model(np.zeros(1, np.int8), np.zeros(1, np.int8), np.zeros(1), np.linspace(0.2, 0.99, mixing.RUNS))
    before = b"once more and once more and once mo"
    each = np.full((3, len(before) + 2), -math.log(256))
    last = [model.with_repeats(each.copy(), before + bytes([byte]))[:, len(before)] for byte in range(256)]
    assert np.exp(last).sum(axis=0) == pytest.approx([1, 1, 1]) and max(last, key=max) is last[ord("r")]


def test_score_beats_chance(documents):
    rows = rows_of(mixing.lm_scores(documents))
    size = {r.doc_id: len(r.text.encode()) + 1 for r in documents.collect()}
    held = [r for r in rows if r["held_out"]]
    assert -sum(r["score"] for r in held) * math.log2(10) / sum(size[r["doc_id"]] for r in held) < 4


# 7: toxicity


def test_toxicity(spark, empty):
    bad, good = ["vile", "scumbag", "rotten"], ["garden", "river", "window", "paper", "music", "green"]
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(600):
        ws = list(rng.choice(good, 30))
        if i % 3 == 0:
            ws[5] = bad[i % 9 // 3]
        docs.append((i, " ".join(ws)))
        labels.append((i, int(i % 3 == 0)))
    docs += [(1000, None), (1001, ""), (None, "a vile thing"), (1, "repeated id"), (1002, LONG)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, label int")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    rows = rows_of(toxicity.score_toxicity(frame, marks))
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    truth = dict(labels)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    kept = toxicity.without_toxic(frame, marks)
    assert kept.columns == frame.columns and 390 < kept.count() < 420
    assert toxicity.score_toxicity(empty, marks).count() == 0
    assert toxicity.score_toxicity(frame, marks.limit(0)).count() == len(docs)


# 8 and 9: copies


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def brute_components(docs):
    sets = {d: shingle_set(t) for d, t in docs}
    part = {d: d for d in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= 90 * (len(sets[a]) + len(sets[b]) - same):
                x, y = root(a), root(b)
                part[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_ngram_join_with_a_large_group(spark):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    docs = [(500, " ".join(base))]
    for i in range(300):  # each links with the first text, few with each other
        ws = base[:]
        ws[int(rng.integers(3, 117))] = f"n{i}"
        ws[int(rng.integers(3, 117))] = f"m{i}"
        docs.append((1000 - i, " ".join(ws)))
    chain = [f"c{i}" for i in range(200)]
    for i in range(12):
        docs.append((2000 + i, " ".join(chain[3 * i:] + [f"t{i}-{k}" for k in range(3 * i)])))
    docs += [(3000 + i, " ".join(rng.choice(base, 8))) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(frame).collect()}
    assert got == brute_components(docs)


def test_ngram_join_awkward(awkward, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(awkward).collect() if r.doc_id is not None}
    assert got == brute_components([d for d in AWKWARD if d[0] is not None])
    assert ngram_join.ngram_join(awkward).count() == len(AWKWARD)
    kept = ngram_join.one_of_each(awkward)
    assert kept.columns == awkward.columns and {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12}
    assert ngram_join.ngram_join(empty).count() == 0


def test_exact_groups(awkward, empty):
    rows = rows_of(exact.exact_groups(awkward))
    groups = collections.defaultdict(list)
    for d, t in AWKWARD:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    want = sorted((str(d), str(min((x for x in g if x is not None), default=None)), len(g), hashlib.sha256(k.encode()).hexdigest())
                  for k, g in groups.items() for d in g)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in rows) == want
    assert sum(r["kept"] for r in rows) == len(groups)
    assert exact.exact_dedup(awkward).count() == len(groups) and exact.exact_dedup(awkward).columns == awkward.columns
    assert exact.exact_groups(empty).count() == 0


# 10: personal data


def brute_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1.@-+ ()%923é7", max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_awkward(awkward, empty):
    rows = rows_of(pii.find_pii(awkward))
    want = sorted((str(d), hashlib.sha256(pii.joined(brute_spans(t or "")).encode()).hexdigest()) for d, t in AWKWARD)
    assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in rows) == want
    ten = next(r for r in rows if r["doc_id"] == 10)
    assert (ten["n_email"], ten["n_ip"], ten["n_card"], ten["n_phone"]) == (1, 1, 1, 1)
    assert pii.find_pii(empty).count() == 0


def test_patterns_discover_unseen_identifiers(spark):
    docs = [(i, f"Reach the desk, phone +1 555 010 {1000 + i} now please.") for i in range(12)]
    docs += [(50, "Some phone 555-0199-77 now and 777-88 elsewhere.")]
    rows = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[50].n_phone == 0 and rows[50].spans == "phone:11:22"
    assert all(rows[i].n_phone == 1 and rows[i].spans.count(":") == 2 for i in range(12))


# The pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, at, SF)
        assert after.columns == docs.columns, name
        before, at = at, corpus_pipeline.written(after, "test-stage")
        assert at.count() <= before.count()
        if name == "exact dedup":
            want = {re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in before.collect()}
            assert at.count() == len(want)
        if name.startswith("n-gram"):
            parts = brute_components([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in at.collect()} == {p for _, p in parts.values()}
    rows = rows_of(corpus_pipeline.run(spark, SF))
    check_pieces(rows, [(r.doc_id, r.text) for r in at.collect()])
