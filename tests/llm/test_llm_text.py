"""Compression bands, PII, secrets, decontamination, encoding and toxicity against plain versions."""

import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import zstandard

from ratingloom.llm import blob_ledger, compression_bands, decontamination, ordinal_toxicity, personal_data, prefix_viterbi
from ratingloom.llm.common import bounded_sample
from ratingloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


# --- compression bands -------------------------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text)
    seen = {}
    for n in range(len(words) - 7):
        seen.setdefault(tuple(words[n : n + 8]), []).append(n)
    inside = {k for places in seen.values() if len(places) > 1 for p in places for k in range(p, p + 8)}
    lines, dup, earlier = text.split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in earlier
            earlier.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


def test_base_counts_equal_the_plain_ones(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_compression_bands"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc, text in texts.items():
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_counts(text)
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize("text", ["a b " * 40, "x\n\n x \nx\n x ", "é ü ü\x1cb", "w1 w2 w3 w4 w5 w6 w7 w8 " * 2 + "end"])
def test_odd_texts_have_the_plain_counts(text):
    assert compression_bands.judge_text(text, zstandard.ZstdCompressor())[:6] == plain_counts(text)


def test_repetitive_and_random_texts_leave_their_band(texts):
    import random

    rng = random.Random(3)
    judge = lambda t: compression_bands.judge_text(t, zstandard.ZstdCompressor(level=3))[6]
    prose = max(texts.values(), key=lambda t: len(set(t.split())) if not re.search(r"[#*$%&|<>]{2}", t) else 0)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=40)) for _ in range(120))
    lists = " ".join(f"item{n % 7} value{n % 11} and" for n in range(2_000))
    assert judge(prose) and not judge(noise) and not judge(lists)
    # good prose in front does not hide a bad stretch of more than a third
    assert not judge(prose[:8_000] + " " + noise * 3)


# --- PII -----------------------------------------------------------------------------------------


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        total = sum(x if n % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for n, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    kinds = ["email", "ip", "card", "phone"]
    return sorted(out, key=lambda s: (kinds.index(s[0]), s[1]))


def test_base_spans_equal_the_plain_ones(spark, texts):
    for r in QUERIES["op2_semi_markov_pii"](spark, SF).collect():
        want = plain_spans(texts[r.doc_id])
        listed = [f"{k}:{s}:{e}" for k, s, e in want]
        assert r.base_sha256 == sha(listed)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in personal_data.KINDS]
        assert set(listed) <= set(r.spans.split(",")) if listed else True


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e.f @x.y q@", "1.2.3.4.5.6.7.8", "999.1.1.1 01.002.3.4", "4111 1111-1111 1111 2", "+1 (2) 3.4-5 6 7 8 9 0", "++1 555 0000 00+2 3", "é@ö.de ü1@a.b-c..d", "9" * 5_000],
)
def test_odd_spans_equal_the_plain_ones(text):
    assert sorted(personal_data.base_spans(text)) == sorted(plain_spans(text))


def test_the_field_adds_free_forms_and_leaves_plain_numbers(texts):
    weights = personal_data.train([texts[d] for d in sorted(texts)] * 1)
    found = lambda t: [(k, t[s:e]) for k, s, e in sum(personal_data.all_spans(t, weights), [])]
    assert found("call (017) 555-7713 now") == [("phone", "(017) 555-7713")]
    assert found("the year 1998-2004 and pages 12.5.3") == []
    assert found("on 2024-10-11 12:30:00 sharp") == []
    assert found("") == [] and personal_data.masked(None, weights) is None
    assert personal_data.masked("to bob@example.com, now", weights) == "to <email>, now"


def test_regions_hide_nothing_from_the_field(spark, texts):
    weights = personal_data.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))

    def whole(text):
        region = personal_data.Region(text)
        found = [(k, region.tokens[i][0], region.tokens[j - 1][1]) for i, j, k in personal_data.best_segmentation(region, weights)]
        return [f for f in found if all(f[2] <= s or e <= f[1] for _, s, e in personal_data.base_spans(text))]

    prose = "Please write to them, since nobody in this office knows, at noon. Then ask "
    values = {"phone": "+1 (017) 555-7713", "email": "jane@mail.example.com", "card": "4111 1111 1111 1111", "ip": "10.20.30.40"}
    forms = [t for kind, v in values.items() for t, _ in personal_data._free_forms(v, (kind, 0, len(v)))]
    forms += ["jane at example dot com", "bob @ mail dot example dot com", "x1 9 " * 30, "at " * 40]
    for form in forms:
        for text in (form, prose + form + " and wait for some days until an answer comes. " + prose, "7 " * 20 + form + " ..." * 9 + " 5" * 20):
            assert personal_data.all_spans(text, weights)[1] == whole(text), text
    for text in texts.values():
        assert personal_data.all_spans(text, weights)[1] == whole(text)
    for form in ("jane at example dot com", "bob @ mail dot example dot com"):
        text = "Please ask " + form + ", who knows"
        assert personal_data.masked(text, weights) == "Please ask <email>, who knows"
    assert personal_data.all_spans("They stayed at home. Then it rained", weights) == ([], [])


def test_added_spans_never_touch_base_ones(texts):
    weights = personal_data.train([texts[d] for d in sorted(texts)])
    for text in texts.values():
        base, added = personal_data.all_spans(text, weights)
        assert all(e <= s2 or e2 <= s for _, s, e in added for _, s2, e2 in base)


def test_segmentation_is_the_best_of_all():
    region = personal_data.Region("x 12 34 567 y")
    weights = {f: ((hash_ := sum(map(ord, f))) % 7 - 3) / 4 for seg in region.segments for _, _, fs in seg for f in fs}

    def best(i):
        if i >= len(region.words):
            return 0.0
        options = [best(i + 1)]
        options += [sum(weights[f] for f in fs) - 1.0 + best(j) for j, _, fs in region.segments[i]]
        return max(options)

    chosen = personal_data.best_segmentation(region, weights, 1.0)
    score = 0.0
    for i, j, kind in chosen:
        score += next(sum(weights[f] for f in fs) - 1.0 for jj, k, fs in region.segments[i] if (jj, k) == (j, kind))
    assert score == pytest.approx(best(0))


# --- secrets ---------------------------------------------------------------------------------------


def plain_secrets(text):
    out = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def test_findings_equal_the_plain_ones(spark, texts):
    rows = QUERIES["op3_blob_ledger"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_secrets(texts[r.doc_id])
        assert r.spans == ",".join(want) and r.base_sha256 == sha(want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign:", "access:", "hex:")]


def test_only_unseen_blobs_and_rules_are_scanned(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    key = "AKIA" + "A1" * 8
    first = spark.createDataFrame([("a", f"x {key}"), ("b", f"x {key}"), ("c", None), ("é", "ü " * 3 + "Token: 'abcdef12'")], "doc_id string, text string")
    got = {r.doc_id: r.spans for r in blob_ledger.scan_secrets(first, ledger).collect()}
    assert got == {"a": "access:2:22", "b": "access:2:22", "c": "", "é": "assign:6:22"}
    scanned = lambda: spark.read.parquet(f"{ledger}/scanned").count()
    assert scanned() == 3 * 3  # three blobs, three rules
    second = first.union(spark.createDataFrame([("d", f"x {key}"), ("a", "new text")], "doc_id string, text string"))
    assert len(blob_ledger.scan_secrets(second, ledger).collect()) == 6
    assert scanned() == 4 * 3
    newer = (*blob_ledger.RULES[:2], blob_ledger.Rule("hex", 2, lambda b: [(0, 1)] if b else []))
    got = {(r.doc_id, r.spans) for r in blob_ledger.scan_secrets(second, ledger, newer).collect()}
    assert scanned() == 4 * 3 + 4 and ("d", "hex:0:1,access:2:22") in got and ("c", "") in got
    # a job that died after writing findings and before the ledger entry leaves repeats only
    spark.read.parquet(f"{ledger}/findings").coalesce(1).write.mode("append").parquet(f"{ledger}/findings")
    again = {(r.doc_id, r.spans) for r in blob_ledger.findings_by_path(second, ledger, newer).collect()}
    assert again == got


# --- decontamination -------------------------------------------------------------------------------


def plain_hits(text, items, width=10):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        own = words_of(t)
        size = min(width, len(own))
        for n in range(len(own) - size + 1 if own else 0):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[n : n + size]:
                    hit |= set(range(p, p + size))
                    found.add(str(item))
    return len(words), len(hit), len(found), sha(sorted(found)), bool(hit)


def test_hits_equal_the_plain_ones_in_one_and_in_many_blocks(spark):
    items = [(1, "One two three four five six seven eight nine ten eleven"), (2, "Ünï-code words"), (10, "words"), (3, ""), (4, None), (5, "one TWO three four five six seven eight nine ten")]
    texts = ["zero one two THREE four five six, seven eight nine ten eleven! twelve", "ünï--code  words", "Ünïcode", None, "", "words words\nwords", "one two three four five six seven eight nine", "sword swords"]
    docs = spark.createDataFrame([(n, t, True) for n, t in enumerate(texts)], "doc_id long, text string, contaminated boolean")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontamination.MAX_BYTES, 20):
        for r in decontamination.find_contamination(docs, bench, max_bytes=most).collect():
            assert tuple(r[1:6]) == plain_hits(texts[r.doc_id], items)
            assert sum(len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id][s:e].lower())) for s, e in r.hit_spans) == r.n_hit
    assert decontamination.find_contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_blocks_are_bounded_and_items_may_lack_an_id(spark, monkeypatch):
    words = [f"word{n}" for n in range(60)]
    items = [(None, " ".join(words[:12])), (1, " ".join(words[5:30])), (2, " ".join(words)), (None, "short one"), (7, "a b")]
    texts = [" ".join(words[2:14]), " ".join(words[20:31]), "Short ONE and a b", " ".join(words), None, "nothing", " ".join(words[2:14])]
    docs = spark.createDataFrame([(n % 6, t) for n, t in enumerate(texts)] + [(None, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = lambda most: sorted((tuple(r) for r in decontamination.find_contamination(docs, bench, max_bytes=most).collect()), key=repr)
    one = found(10_000)
    for r in one:
        if r[0] is not None:
            n_words, n_hit, n_items, _, hit = plain_hits(texts[r[0]], items)
            assert r[1:4] == (n_words, n_hit, n_items) and r[5] == hit
    sizes = []
    built = decontamination.scanner
    monkeypatch.setattr(decontamination, "scanner", lambda s, b, w: (sizes.append(sum(len(t) for _, t in b)), built(s, b, w))[1])
    assert found(150) == one
    assert len(sizes) > 3 and max(sizes) <= 250  # a piece has the words of its last window besides
    clean = [r.text for r in decontamination.uncontaminated(docs, bench, max_bytes=150).collect()]
    assert sorted(map(str, clean)) == ["None", "nothing"]


def test_spans_are_code_points_of_the_original():
    automata = [decontamination.automaton_of(decontamination.windows_of([(7, "naïve Café")]))]
    text = "Ωmega,  NAïVE -- CAFé!"
    spans = decontamination.scan_text(text, automata)[5]
    assert [text[s:e] for s, e in spans] == ["NAïVE -- CAFé"]


# --- encoding ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=prefix_viterbi.MODEL)


def test_ids_equal_those_of_the_library(spark, texts, library):
    rows = QUERIES["op8_prefix_viterbi"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.token_ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip


def test_odd_texts_have_the_ids_of_the_library(library):
    odd = ["", " ", "  a  b\n\nc x \t end  ", "aaaa" * 40, "日本語 🙂🙂", "á \x00 \x7f", "don't — stop…", "    for(i=0;i<9;i++){}", "ABCabc  DEF   ghi    jkl     m", "naïve Straße ¿qué?"]
    encode = prefix_viterbi._encoder(prefix_viterbi.MODEL)
    for text, (_, _, ids, same) in zip(odd, encode(odd)):
        assert list(ids) == library.encode(text), text
        assert same


def test_long_runs_of_spaces_take_no_square_time(library):
    vocab = prefix_viterbi.vocabulary()
    for text in ("a" + " " * 1_000 + "b", " " * 777, "x  y   z" + " " * 333 + "▁▁ ", "ab" * 40 + "   " + "é" * 30):
        words = prefix_viterbi.marked_words(text)
        ids = prefix_viterbi.encode_words(set(words), vocab)
        assert [i for w in words for i in np.frombuffer(ids[w], np.int32)] == library.encode(text)
    begun = time.time()
    long = prefix_viterbi.encode_words({"▁" * 1_000_000}, vocab)
    assert time.time() - begun < 30 and len(long["▁" * 1_000_000]) == 4 * 1_000_000 // 16


def test_common_prefixes_share_their_states():
    vocab = prefix_viterbi.vocabulary()
    words = sorted({"▁internation", "▁international", "▁internationally", "▁intern"})
    encoder = prefix_viterbi.PrefixEncoder(vocab)
    for word in words:
        assert [vocab.names[i] for i in encoder.ids(word)] == vocab.merge(word)
    assert encoder.nodes == len("▁internationally")


def test_decoding_gives_the_texts_back(spark):
    rows = [(1, "two  spaces"), (2, None), (3, "ünï ▁ mark"), (1, "two  spaces")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = prefix_viterbi.encode_texts(docs)
    back = [(r.doc_id, r.text) for r in prefix_viterbi.decode_ids(encoded).collect()]
    assert back == [(1, "two  spaces"), (2, ""), (3, "ünï   mark"), (1, "two  spaces")]
    assert [r.round_trip for r in encoded.collect()] == [True, True, False, True]


# --- toxicity ------------------------------------------------------------------------------------------


def test_held_out_texts_are_judged_right(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = sorted((r.doc_id, r.text, r.toxic) for r in docs.join(labels, "doc_id").collect())
    fit, held = [r for r in rows if r[0] % 3], [r for r in rows if r[0] % 3 == 0]
    score = ordinal_toxicity.Scorer(ordinal_toxicity.train([(t, y) for _, t, y in fit]))
    verdicts = [(y, score(t)[3]) for _, t, y in held]
    assert sum(v for y, v in verdicts if not y) <= 0.005 * len(held)  # clean texts are left alone
    assert sum(v for y, v in verdicts if y) >= 0.9 * sum(y for y, _ in verdicts)


def test_thresholds_are_ordered_and_severity_grows():
    clean = [(f"calm words number {n} here", 0) for n in range(40)]
    toxic = [("vile " * (1 + n % 9) + f"words {n}", 1) for n in range(30)]
    model = ordinal_toxicity.train(clean + toxic + [("x", None)])
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == ordinal_toxicity.GRADES
    score = ordinal_toxicity.Scorer(model)
    severities = [score("vile " * n)[0] for n in (0, 1, 4, 9)]
    assert severities == sorted(severities) and severities[0] < 0.5 < severities[-1] <= ordinal_toxicity.GRADES
    assert not score(None)[3] and not score("calm words")[3] and score("vile vile vile")[3]
    # one threshold: the same weights serve all, so P(grade > k) falls with k for any text
    assert ordinal_toxicity.train([("a", 0), ("b", 0)]).features == {}
    assert not ordinal_toxicity.Scorer(ordinal_toxicity.train([("a", 1)]))("a")[3]


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_neutral_texts_are_never_rejected(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    model = ordinal_toxicity.fit(docs, spark.read.parquet(f"/root/testdata/sf{sf}/labels.parquet"))
    score = ordinal_toxicity.Scorer(model)
    neutral = [None, "", " ", "12345", "Buy now", "Guten Tag zusammen", "The meeting is on Monday at ten.", "words", "\U0001f600"]
    assert [t for t in neutral if score(t)[3]] == []
    assert score("")[1] < 0.2 and score("")[0] < 0.5 and score("")[2] == 0
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(neutral)], "doc_id long, text string")
    assert rows.filter(~ordinal_toxicity.is_toxic(rows["text"], model)).count() == len(neutral)


def plain_severity(model, text):
    """The cumulative-link formula from all features of the text, without any cache."""
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        counts.update([word + "$", *[word[:n] for n in (3, 4, 5, 6, 7, 8) if n <= len(word)]])
    known = [f for f in counts if f in model.features]
    score = sum(model.features[f] * np.log1p(counts[f]) for f in known)
    p = [1 / (1 + np.exp(-np.clip(score - cut, -40, 40))) for cut in model.thresholds]
    toxic = bool(known) and p[0] >= ordinal_toxicity.REJECT_AT
    return sum(p), p[0], max(int(toxic), sum(x >= 0.5 for x in p)), toxic


def test_scores_equal_the_formula(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = ordinal_toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = ordinal_toxicity.score_toxicity(docs, model, keep=("doc_id", "text")).collect()
    assert len(rows) == docs.count() and any(r.toxic for r in rows)
    for r in rows:
        severity, p, grade, toxic = plain_severity(model, r.text)
        assert r.expected_severity == pytest.approx(severity, abs=1e-9) and r.p_toxic == pytest.approx(p, abs=1e-9)
        assert (r.grade, r.toxic) == (grade, toxic)


def test_samples_are_bounded(spark):
    df = spark.range(5_000).withColumnRenamed("id", "doc_id")
    assert 60 < bounded_sample(df, "doc_id", 100).count() <= 200
    assert bounded_sample(df.limit(0), "doc_id", 100).count() == 0
    assert bounded_sample(df, "doc_id", 10_000).count() == 5_000
