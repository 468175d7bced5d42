"""Filter audit, tier packing and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratingloom.llm import filter_audit, tier_packing, word_runs
from ratingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, mask int, part string, h long, n int, start int, rest boolean"


def odd_rows():
    long_text = "many words of one very long text, number {} " * 1
    return [
        (1, None, "en", None, 1, "a", 2, 3, 4, True),
        (2, "", "en", "", 1, "a", 2, 3, 4, True),
        (3, " \n\t ", "en", "s", 1, "a", 2, 3, 4, True),
        (4, "same text here", "en", "s", 1, "a", 2, 3, 4, True),
        (5, "same text here", "en", "s", 1, "a", 2, 3, 4, True),
        (5, "same text here", "en", "s", 1, "a", 2, 3, 4, True),
        (5, "another text of the same id", "en", "t", 1, "a", 2, 3, 4, True),
        (6, "another text of the same id", "en", "t", 1, "a", 2, 3, 4, True),
        (None, "same text here", "en", "s", 1, "a", 2, 3, 4, True),
        (None, "no id $", "en", "s", 1, "a", 2, 3, 4, True),
        (None, "no id $", "en", "s", 1, "a", 2, 3, 4, True),
        (-7, "ÄÖ \U0001f600 ABC abc", "en", "s", 1, "a", 2, 3, 4, True),
        (8, "".join(long_text.format(n % 50) for n in range(30_000)), "en", "s", 1, "a", 2, 3, 4, True),
        (9, "word " * 5_000, "en", "s", 1, "a", 2, 3, 4, True),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


# --- filter audit --------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """rows (doc_id, text, source), labels (doc_id, quality, toxic)."""
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs = defaultdict(list)
    for d, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t))
        fails += "D" * bool(re.search(r"[#$%&*|]", t))
        fails += "E" * (d is not None and d > first[t])
        docs[s or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, held in docs.items():
        shapley = Counter()
        made = []
        for order in permutations("ABCDE"):
            left = held
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(removed)
                failing = [x for x in held if f in x[0]]
                made.append((("".join(order), step), f, (len(left), len(removed), len(failing) - len(removed), sum(x[0] == f for x in held), sum(x[1] for x in removed), sum(x[2] for x in removed))))
        for key, f, figures in made:
            out[(part, *key)] = (*figures, shapley[f])
    return out


def audit_of(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_equals_the_plain_one(spark, odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    labels = [(4, 1, 0), (5, 1, 1), (5, 0, 0), (8, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit(rows, labels)
    assert audit_of(filter_audit.audit_filters(odd, table)) == want
    # a sketch far too small lets every text through to the exact step
    assert audit_of(filter_audit.audit_filters(odd.repartition(5), table, max_slots=1)) == want
    assert len(want) == 3 * 600


def test_audit_of_an_empty_table(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(odd.limit(0), labels).collect() == []
    assert len(filter_audit.audit_filters(odd.limit(1), labels).collect()) == 600


def test_the_sketch_clears_unique_texts_and_no_repeated_one(spark):
    texts = [f"text {n}" for n in range(20_000)] + [f"text {n}" for n in range(0, 20_000, 40)] + ["hot"] * 3_000
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(7).select("t", F.xxhash64("t").alias("h"))
    crowded = filter_audit.may_repeat(rows.select("h"))
    passed = Counter(r.t for r in rows.filter(crowded("h")).collect())
    counts = Counter(texts)
    assert all(passed[t] == n for t, n in counts.items() if n > 1)
    assert sum(1 for t, n in counts.items() if n == 1 and t in passed) < 0.02 * len(counts)


# --- packing -------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tier_packing.TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def assert_packed(rows, wanted, padded=2_048):
    """Every id of every document lies in exactly one piece, and every sequence is gapless and unpadded."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        docs[r.doc_id].append((r.start, ids.tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_tokens, r.step_group))
    assert Counter(n for d in docs for n in [d]).keys() == {d for d, _ in wanted}
    for d, ids in wanted:
        pieces = sorted(docs[d])
        assert [i for _, part, _ in pieces for i in part] == ids and {n for _, _, n in pieces} == {len(ids)}
        assert [s for s, _, _ in pieces] == np.cumsum([0] + [len(p) for _, p, _ in pieces])[:-1].tolist()
    for pieces in sequences.values():
        pieces.sort()
        total = sum(n for _, n, _, _ in pieces)
        assert [o for o, *_ in pieces] == np.cumsum([0] + [n for _, n, _, _ in pieces])[:-1].tolist()
        assert {x[2:] for x in pieces} == {(total, pieces[0][3])}
        assert total <= padded and total & (total - 1) == 0  # a power of two needs no padding
    return sequences


@pytest.mark.parametrize("tasks", [1, 9])
def test_every_id_is_packed_once_without_padding(spark, library, tasks):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(tasks)
    rows = tier_packing.pack_documents(docs, with_ids=True, round_tokens=1 << 14, step_tokens=1 << 12).collect()
    sequences = assert_packed(rows, [(r.doc_id, library(r.text)) for r in docs.collect()])
    lengths = Counter(pieces[0][2] for pieces in sequences.values())
    assert {512, 1_024, 2_048} <= set(lengths)  # the shortest documents may all go into gaps
    assert sum(n for size, n in lengths.items() if size < 128) <= 7  # only the rest of the rests is cut finely
    groups = defaultdict(int)
    for pieces in sequences.values():
        groups[pieces[0][3]] += pieces[0][2]
    full = [n for g, n in groups.items() if g < tier_packing.REST_SEQUENCES]
    assert max(full) <= 2 * (1 << 12)


def test_odd_documents_are_packed(spark, library, odd):
    kept = odd.filter("doc_id NOT IN (5) OR doc_id IS NULL").filter("doc_id IS NOT NULL")
    rows = tier_packing.pack_documents(kept, with_ids=True).collect()
    assert_packed(rows, [(r.doc_id, library(r.text)) for r in kept.collect()])
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert [(r.length, r.doc_tokens, r.ids_crc32) for r in empty] == [(1, 1, zlib.crc32(b"\1\0\0\0"))] * 3
    every = tier_packing.pack_documents(odd, with_ids=True).collect()  # null and repeated ids
    assert sum(r.length for r in every) == sum(len(library(r.text)) for r in odd.collect())
    assert tier_packing.pack_documents(odd.limit(0)).collect() == []


def test_words_have_the_ids_of_the_whole_text(library, monkeypatch):
    rng = random.Random(3)
    parts = ["word", "Straße", "ΣΑΣ", "é", "e\u0301", "\u0301", "<|endoftext|>", " ", " x", "'s", "12", "!?", "\U0001f600", "\r\n", "  ", "\xa0", "\x1c", "\u2003", "\x85", "İ", "ﬁ", "한", "글"]
    encode = tier_packing.Words(tier_packing.TOKENIZER)
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "\n", "\t", "\x0b"]) for _ in range(rng.randrange(40))) for _ in range(400)]
    assert [encode(t).tolist() for t in texts] == [library(t) for t in texts]
    monkeypatch.setattr(tier_packing, "CACHE_PIECES", 5)
    encode = tier_packing.Words(tier_packing.TOKENIZER)
    assert [encode(t).tolist() for t in texts[:50]] == [library(t) for t in texts[:50]]
    assert len(encode.known) < 60


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 5_000), max_size=60))
def test_windows_are_full_and_lose_nothing(sizes):
    pieces = [((n, s), 0, np.arange(s, dtype=np.uint32)) for n, s in enumerate(sizes)]
    full, rest = tier_packing.pack(pieces)
    rows = [*full, *tier_packing.powers_of_two(rest)]
    assert all(sum(len(i) for *_, i in row) in tier_packing.TIERS for row in full)
    assert sum(len(i) for *_, i in rest) < 2_048
    seen = defaultdict(list)
    for row in rows:
        total = sum(len(i) for *_, i in row)
        assert total & (total - 1) == 0
        for doc, start, ids in row:
            assert ids[0] == start
            seen[doc] += ids.tolist()
    assert {d: sorted(v) for d, v in seen.items()} == {(n, s): list(range(s)) for n, s in enumerate(sizes)}


def test_step_groups_are_balanced():
    rng = random.Random(1)
    sizes = [rng.choice(tier_packing.TIERS) for _ in range(3_000)]
    groups = tier_packing.step_groups(sizes)
    tokens, squares = Counter(), Counter()
    for s, g in zip(sizes, groups):
        tokens[g] += s
        squares[g] += s * s
    assert len(tokens) == round(sum(sizes) / tier_packing.STEP_TOKENS)
    assert max(tokens.values()) - min(tokens.values()) <= 2_048
    assert max(squares.values()) <= 1.1 * min(squares.values())


# --- periodic runs -------------------------------------------------------------------------------------


def plain_runs(words, shortest=12):
    found = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            begin = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - begin >= max(shortest, 2 * p):
                found.setdefault((begin, i + p), p)
            i += 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def runs_in(texts, shortest):
    rows, begins = word_runs.runs_of_texts([[w.encode() for w in t] for t in texts], shortest)
    out = [[] for _ in texts]
    for s, e, p in rows.tolist():
        n = int(np.searchsorted(begins, s, side="right")) - 1
        out[n].append((s - int(begins[n]), e - s, p))
    return out


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 7)), max_size=5), max_size=4), st.sampled_from([2, 12]))
def test_runs_equal_the_plain_ones(made, shortest):
    texts = [list("".join(u * n for u, n in text)) for text in made]
    assert runs_in(texts, shortest) == [plain_runs(t, shortest) for t in texts]


def test_runs_of_hard_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    near = "ab" * 30 + "a" + "ba" * 30  # squares of many periods around the middle
    thue = "a"
    while len(thue) < 256:
        thue += "".join("ba"[c == "b"] for c in thue)
    texts = [list(t) for t in (fib[-1], near, thue, "a" * 400, "abaab" * 40 + "b" + "abaab" * 40, "")]
    for shortest in (2, 12):
        assert runs_in(texts, shortest) == [plain_runs(t, shortest) for t in texts]


def test_range_successors_equal_sorted_search():
    rng = np.random.default_rng(4)
    values = rng.permutation(1_000)
    wavelet = word_runs.Wavelet(values)
    low = rng.integers(0, 1_000, 500)
    high = np.minimum(1_000, low + rng.integers(0, 300, 500))
    least = rng.integers(0, 1_000, 500)
    got = wavelet.successor(low, high, least, 9_999)
    want = [min((v for v in values[a:b] if v >= x), default=9_999) for a, b, x in zip(low, high, least)]
    assert got.tolist() == want


def plain_row(doc_id, text):
    words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + size for s, size, p in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    start, length, period = best or (None, None, None)
    return (doc_id, len(runs), start, length, period, best and 1000 * length // period, sha(lines), sha(" ".join(kept)))


def test_the_query_equals_the_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) <= 700]
    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    want = {plain_row(*r) for r in short}
    assert want <= got and sum(r[1] > 0 for r in want) > 5


def test_odd_documents_have_their_runs(spark, odd):
    found = word_runs.digests(word_runs.find_runs(odd, prepare=word_runs.planted))
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    small = [r for r in odd.collect() if r.doc_id not in (8, 9)]
    want = sorted((plain_row(r.doc_id, r.text) for r in small), key=repr)
    assert [r for r in got if r[0] not in (8, 9)] == want
    by_id = {r[0]: r for r in got}
    assert by_id[9][1:6] == (1, 0, 5_000, 1, 5_000_000) and by_id[9][7] == hashlib.sha256(b"word").hexdigest()
    assert by_id[8][1] == 1 and by_id[8][4] == 50 * 9
    assert word_runs.find_runs(odd.limit(0)).collect() == []
    plain = word_runs.find_runs(odd.filter("doc_id = 9")).first()
    assert plain.n_words == 5_000 and plain.collapsed == "word" and [tuple(r) for r in plain.runs] == [(0, 5_000, 1)]
