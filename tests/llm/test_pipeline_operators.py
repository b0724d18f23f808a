"""The five operators of the pipeline, on small tables with every odd case."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from retalake.llm import decontamination, near_dedup, packing, pii, quality_rules
from retalake.llm.common import tokenizer_path

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (5, "one two"), (None, "one two three four"), (6, "é😀 ß")]
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


# --- quality rules


def brute_statistics(text):
    w = [x.decode() for x in (text or "").encode().split()]
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, texts):
    rng = random.Random(1)
    rows = [(100 + i, "".join(rng.choice("ab #\n\t é$") for _ in range(rng.randrange(200)))) for i in range(200)]
    rows += [*ODD, (7, "a b c " * 5000), (8, "x" * 100_000), (9, "l\nl\nl\n m\n m"), (10, "a b c d a b c d a b")]
    got = quality_rules.statistics(texts(*rows)).select("doc_id", "stats").collect()
    found = collections.Counter(
        (r.doc_id, r.stats.n_words, r.stats.word_chars, r.stats.n_symbols, r.stats.n_dup_lines, r.stats.n_repeat_words)
        for r in got
    )
    assert found == collections.Counter((i, *brute_statistics(t)) for i, t in rows)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 50, 0.01), (3, 900, 0.01), (40, 10_000, 0.01), (9, 1000, 0.01), (200, 1000, 0.01)])
def test_binomial_tail(spark, k, n, p):
    from math import comb

    got = spark.range(1).select(quality_rules.binomial_tail(*(quality_rules.F.lit(float(x)) for x in (k, n)), p)).first()[0]
    exact = 1.0 if k > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(exact, rel=1e-8)


@pytest.mark.parametrize(("k", "n"), [(19_000, 2_000_000), (29_600, 3_000_000), (99_000, 10_000_000)])
def test_binomial_tail_of_many_trials(spark, k, n):
    from math import exp, fsum, lgamma, log, log1p

    p = 0.01
    largest = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p))
    terms = [1.0]
    for j in range(k):  # all of them, without a bound
        terms.append(terms[-1] * (k - j) / (n - k + j + 1) * ((1 - p) / p))
    got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    assert 0 < got < 0.02
    assert got == pytest.approx(largest * fsum(terms), rel=1e-6)


def test_cutoffs_keep_their_limit(spark, texts):
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice("abcdefgh") * rng.randrange(3, 8) + str(rng.random())[2:5] for _ in range(60))
    good = [(i, prose()) for i in range(1500)]
    bad = [(2000 + i, " ".join(w + "###" for w in prose().split())) for i in range(300)]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(None, 1, 0), (0, None, 1)]
    docs = texts(*good, *bad, (None, None))
    kept = quality_rules.accepted(spark, docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & {i for i, _ in good}) >= 1425  # at most 5 % of the good ones go
    assert not ids & {i for i, _ in bad}
    assert None not in ids


def test_copies_are_one_trial_and_null_is_no_empty_language(spark, texts, monkeypatch):
    seen = []
    certify = quality_rules.certified_cutoffs
    monkeypatch.setattr(quality_rules, "certified_cutoffs", lambda holdout, *a: seen.append(holdout) or certify(holdout, *a))
    words = " ".join(f"word{i}" for i in range(60))
    copies = [(i, words) for i in range(30)] + [(40, words + " a"), (40, words + " b")]
    docs = texts(*copies, lang="").union(texts((50, words), (51, words), lang=None))
    labels = spark.createDataFrame([(i, int(i != 3), 0) for i in range(60)], LABELS)
    assert quality_rules.quality_filter(spark, docs, labels).count() == 34
    trials = sorted((r.stratum, r.good) for r in seen[0].collect())
    assert trials == [("=", False), ("=", True), ("=", True), ("null", True)]


def test_no_cutoff_beyond_the_terms_that_are_summed(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "TAIL_TERMS", 5)
    tails = spark.range(1).select(*[quality_rules.binomial_tail(F.lit(k), F.lit(1000), 0.05) for k in (5, 6)]).first()
    assert tails[0] < 1e-9 and tails[1] == 1


def test_quality_without_labels_or_documents(spark, texts):
    none = spark.createDataFrame([], LABELS)
    judged = quality_rules.quality_filter(spark, texts(*ODD, (9, "a1 b2 c3 d4 e5 " + " ".join(map(str, range(60))))), none)
    assert {r.doc_id for r in judged.where("kept").collect()} == {9}
    assert judged.count() == len(ODD) + 1
    assert quality_rules.quality_filter(spark, texts(*ODD).where("false"), none).count() == 0


# --- near duplicates


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            near = both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
            if near or rows[a][0] == rows[b][0]:
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, texts, size, percent):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((4, 20, 80, 200)))]
        for _ in range(rng.choice((1, 2, 12))):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((rng.randrange(10_000) + 10_000 * g, " ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy)))
    rows += [(i, t) for i, t in ODD if i is not None]
    rng.shuffle(rows)
    got = near_dedup.near_duplicates(spark, texts(*rows), percent, size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_dense_group_in_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(spark, texts(*rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 3, 85)


def test_fine_sketches_are_short_and_tell_the_similarity(spark, texts, monkeypatch):
    travelled = []
    pairs = near_dedup.bucket_pairs

    def seen(members, least, percent):
        travelled.extend(len(r["fine"]) for r in members.select("fine").collect())
        return pairs(members, least, percent)

    monkeypatch.setattr(near_dedup, "bucket_pairs", seen)
    rng = random.Random(5)
    copies = [" ".join(f"x{rng.randrange(1000)}" if rng.random() < 0.06 else f"w{i}" for i in range(80)) for _ in range(60)]
    got = near_dedup.near_duplicates(spark, texts(*enumerate(copies))).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(list(enumerate(copies)), 3, 85)
    assert travelled and max(travelled) <= 1500  # a row for each bucket and block carries one

    a, b = near_dedup.hash_functions(near_dedup.FINE)
    for shared in (300, 170, 20, 0):  # of 300 + 300 shingles
        sets = np.random.default_rng(shared).integers(0, 2**64, 600, dtype=np.uint64)
        x, y = (np.frombuffer(near_dedup.fine_sketch(s, a, b), "<u8") for s in (sets[:300], sets[300 - shared : 600 - shared]))
        jaccard = shared / (600 - shared)
        expected = near_dedup.FINE * (jaccard + (1 - jaccard) / 4)
        assert abs(near_dedup.agreeing(np.stack([y]), x)[0] - expected) < 250


def test_texts_are_chosen_exactly_and_without_the_driver(spark, texts, monkeypatch):
    docs = texts(*[(i, f"text {i}") for i in range(300)], (7, "again"), (None, "none"))
    nodes = spark.createDataFrame([(i,) for i in (7, 7, 250, 999, None)], "doc_id long")
    monkeypatch.setattr(type(docs), "toPandas", None)
    got = near_dedup.chosen_texts(docs, nodes, lambda t: t.encode(), near_dedup.scratch(spark), "some").collect()
    assert sorted((r[0], bytes(r[1])) for r in got) == [(7, b"again"), (7, b"text 7"), (250, b"text 250")]


def test_one_of_each(spark, texts):
    long = " ".join(f"w{i}" for i in range(100))
    docs = texts((3, long), (1, long + " more"), (7, "else " + " ".join(map(str, range(50)))), (None, long), (8, None), (9, None))
    kept = near_dedup.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 7, 8, 9]  # the one without id is a copy
    other = " ".join(f"v{i}" for i in range(80))
    docs = texts((2, long), (2, long), (2, other), (4, other + " x"), (None, other), (None, None), (None, long + " y"), (None, "a b c d"), (None, "A b c d"))
    kept = near_dedup.one_of_each(spark, docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "")[:2] for r in kept) == [(False, 2), (True, 0), (True, 0)]
    assert {(r.text or "").lower() for r in kept if r.doc_id is None} == {"", "a b c d"}
    far = texts((2**63 - 1, long), (-(2**63), other), (None, long))
    assert near_dedup.one_of_each(spark, far).count() == 3
    assert near_dedup.one_of_each(spark, docs.where("false")).count() == 0


# --- benchmark decontamination

PLAIN = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    return PLAIN.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items):
    w, hit, names = plain(text), set(), set()
    for name, item in items:
        q = plain(item)
        n = min(13, len(q))
        windows = {tuple(q[k : k + n]) for k in range(len(q) - n + 1)} if q else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                if name is not None:
                    names.add(str(name))
    return len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_equals_brute_force(spark, texts, monkeypatch):
    rng = random.Random(5)
    some = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyzéß") * 3 for _ in range(n)]
    items = [(i, " ".join(some(n))) for i, n in enumerate((13, 14, 40, 30, 5, 1))] + [(7, None), (8, "!?"), (None, " ".join(some(20)))]
    items += [items[2], (20, items[2][1])]
    rows = [*ODD]
    for i in range(40):
        body = some(rng.randrange(400))
        for _ in range(rng.randrange(4)):
            q = plain(rng.choice(items)[1])
            begin = rng.randrange(max(1, len(q) - 12))
            at = rng.randrange(len(body) + 1)
            body[at:at] = q[begin : begin + rng.choice((12, 13, 20, 60))]
        rows.append((100 + i, "-".join(body).upper() if i % 3 else ", ".join(body)))
    benchmark = spark.createDataFrame(items, ITEMS)
    expected = sorted((str(i), *brute_hits(t, items)) for i, t in rows)
    for most in (decontamination.SET_LEADS, 3):  # as a set in the code, and as a table
        monkeypatch.setattr(decontamination, "SET_LEADS", most)
        got = decontamination.contamination(spark, texts(*rows), benchmark).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"], r.contaminated) for r in got) == expected
    docs = texts(*rows)
    clean = decontamination.without_contaminated(spark, docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not x[4] for x in expected)


def test_empty_benchmark(spark, texts):
    empty = spark.createDataFrame([], ITEMS)
    assert {r.n_hit for r in decontamination.contamination(spark, texts(*ODD), empty).collect()} == {0}
    assert decontamination.contamination(spark, texts(*ODD).where("false"), empty).count() == 0


# --- personal data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_spans(text):
    out, text = [], text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_base_spans_equal_brute_force(spark, texts):
    rng = random.Random(6)
    rows = [(100 + i, "".join(rng.choice("a@.1+ -b(0)2é") for _ in range(80))) for i in range(600)]
    rows += [*ODD, (7, "1.2.3.4.5.6.7.8 a@b.c_d@e.f 000255.1.1.1 1.2.3.256"), (8, "é😀 a@b.co " * 700), (9, "1 " * 20_000)]
    rows += [(10, "a" * 100_000), (11, "4111 1111 1111 1111 +1 (222) 333-4444")]
    got = pii.personal_data(spark, texts(*rows)).collect()
    assert collections.Counter((r.doc_id, str([(s.start, s.end, s.kind) for s in r.base])) for r in got) == collections.Counter(
        (i, str(brute_spans(t))) for i, t in rows
    )


def test_contexts_teach_new_identifiers(spark, texts):
    rows = [(i, f"Please reach me: user{i}@mail.example.com today") for i in range(8)]
    rows += [(20, 'please reach "me": handle-77431 any time'), (21, "the year 2024-2025 was long"), (22, "other words: abc12345 here")]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(spark, texts(*rows)).collect()}
    at = rows[8][1].index("handle")
    assert found[20] == [("learned", at, at + len("handle-77431"))]
    assert found[21] == found[22] == []


def test_redaction(spark, texts):
    docs = texts((1, "é a@b.co x 1.2.3.4"), (2, None), (3, "plain"), (4, "a@1.2.3.4"), (5, ""), (1, "é a@b.co x 1.2.3.4"))
    clean = pii.redacted(spark, docs)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in clean.collect()) == [
        (1, "é [EMAIL] x [IP]"), (1, "é [EMAIL] x [IP]"), (2, ""), (3, "plain"), (4, "[EMAIL]"), (5, "")
    ]
    assert pii.redacted(spark, docs.where("false")).count() == 0


# --- packing


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    rng = random.Random(7)
    rows = ["", " ", "a  b", "a\n b", " a", "a ", "　x 　y", "x<|endoftext|>y <|endoftext|> z", "a \x1c b", "é 'll don't", "ab " * 3000]
    rows += ["".join(rng.choice(" \n\tab'é. 1") for _ in range(40)) for _ in range(400)]
    ids, counts = packing.Encoder(path).encode(rows)
    expected = [e.ids + [1] for e in Tokenizer.from_file(path).encode_batch(rows, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, expected))
    assert ids.tolist() == [i for x in expected for i in x]


def test_every_character_is_cut_as_the_tokenizer_cuts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    rng = random.Random(11)
    signs = "ab1²é.-'\n\t\x85\xa0\u0301中😀<|"
    words = ["<|endoftext|>", "it's", "l'eau", "x\n\ny", "x\n\n", "'t", "''s", "1's", "ÿ", "a\x0bb", "\u0301x"]
    words += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    rows = [" ".join(["x", *words[i : i + 8]]) for i in range(0, len(words), 8)]
    rows += [f"x a{c}a1{c}1.{c}. y{c} z" for c in map(chr, range(0x20000)) if not 0xD800 <= ord(c) < 0xE000]
    encoder = packing.Encoder(path)
    assert (encoder.kinds < packing.STRANGE).sum() > 40_000  # most of these characters are cut here
    ids, counts = encoder.encode(rows)
    expected = [e.ids + [1] for e in Tokenizer.from_file(path).encode_batch(rows, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, expected))
    assert ids.tolist() == [i for x in expected for i in x]


class Counting:
    """A tokenizer that counts the characters it gets."""

    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode_batch_fast(self, texts, **options):
        self.seen.append(sum(map(len, texts)))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_are_encoded_once_whatever_signs_follow():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(300)]
    encoder, seen = packing.Encoder(tokenizer_path("byte_bpe_50k.json")), []
    plain = encoder.tokenizer
    for name, value in list(vars(encoder).items()):
        if hasattr(value, "encode_batch_fast"):
            setattr(encoder, name, Counting(value, seen))
    text = " ".join(["x", *(w + s for s in ("", ".", ",", "!!", ").\n12") for w in words)])
    ids, _ = encoder.encode([text])
    assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, packing.END]
    assert sum(seen) < 1.3 * sum(len(w) + 1 for w in words)


def test_blocks_looked_up_together_equal_single_ones():
    import pyarrow as pa

    rng = random.Random(13)
    rows = [" ".join(rng.choice(("one", "two,", "é.\nx", "", "it's")) for _ in range(rng.randrange(12))) for _ in range(40)]
    path = tokenizer_path("byte_bpe_50k.json")
    until = [1, 9, 10, 40]
    together = packing.Encoder(path).blocks(pa.array(rows, pa.large_string()), until)
    for begin, end, (ids, counts) in zip([0, *until], until, together, strict=False):
        own_ids, own_counts = packing.Encoder(path).encode(rows[begin:end])
        assert ids.tolist() == own_ids.tolist() and counts.tolist() == own_counts.tolist()


def test_cuts_are_the_best():
    rng = random.Random(8)
    for _ in range(50):
        at = sorted({0, *(rng.randrange(1, 200) for _ in range(25)), *range(0, 200, 15), 200})
        penalty = [rng.choice((0, 4, 12)) for _ in at]
        cuts = packing.best_cuts(at, penalty, 40, lambda n: 40 - n)
        pen = dict(zip(at, penalty, strict=True))
        assert all(0 < b - a <= 40 for a, b in zip(cuts, cuts[1:], strict=False))
        best = {0: 0}
        for j in at[1:]:
            best[j] = min(best[i] + 40 - (j - i) + (pen[j] if j < 200 else 0) for i in at if i < j and j - i <= 40)
        assert sum(40 - (b - a) + (pen[b] if b < 200 else 0) for a, b in zip(cuts, cuts[1:], strict=False)) == best[200]


def test_pieces_cover_every_id_once(spark, texts):
    import numpy as np
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(("alpha", "beta.", "gam\nma", "é")) for _ in range(rng.randrange(900)))) for i in range(60)]
    rows += [(None, "no id"), (70, None), (71, ""), (72, "word " * 6000)]
    pieces = packing.pack(texts(*rows), path, with_ids=True).toPandas()
    tokenizer = Tokenizer.from_file(path)
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        own = pieces[pieces.doc_id.isna() if i is None else pieces.doc_id == i].sort_values("start")
        assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert set(own.doc_tokens) == {len(ids)} == {own.length.sum()}
        assert own.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(own.start, own.length, strict=True)]
        assert b"".join(map(bytes, own.ids)) == ids.tobytes()
    padding = used = 0
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]]
        n = int(s.length.sum())
        assert n <= 2048
        used += n
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding < 0.05 * used
    assert packing.pack(texts(*rows).where("false"), path).count() == 0


def test_parts_met_again_are_remembered(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 40)
    encoder = packing.Encoder(tokenizer_path("byte_bpe_50k.json"))
    learned = collections.Counter()
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda parts: learned.update(parts) or learn(parts))
    rng = random.Random(5)
    for k in range(30):
        texts = ["a " + " ".join(["often", "always,", *(f"w{rng.random()}" for _ in range(7))]), "", f"x{k} often é\nz  y"]
        ids, counts = encoder.encode(texts)
        whole = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, packing.END] for t in texts]
        assert ids.tolist() == sum(whole, []) and counts.tolist() == [len(w) for w in whole]
        assert len(encoder.known) <= 40 + 20  # bounded: the most it holds, and the parts of one call
    assert learned["often"] == learned["always,"] == 1
