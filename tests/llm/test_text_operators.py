"""Operators on words against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import alnum, documents, lower, odd_texts, spaced

from civicspark.llm import decontaminate, jaccard_join, lm_score, packed, substring_dedup, tokens


@pytest.mark.parametrize("chunk", [7, 50, 1 << 21])
def test_words_of_arrow_columns(monkeypatch, chunk):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    texts = odd_texts(1)
    for table, split in ((tokens.SPACED, spaced), (tokens.ALNUM, alnum)):
        found = tokens.words(pa.array(texts), table, True)
        for i, text in enumerate(texts):
            own = range(found.first[i], found.first[i + 1])
            assert [found.word(k).decode() for k in own] == split(lower(text))
        words = {found.word(k): found.hashes[k] for k in range(len(found.hashes))}
        assert len(set(words.values())) == len(words)
        assert all(words[found.word(k)] == found.hashes[k] for k in range(len(found.hashes)))


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(50), np.zeros(0, np.int32)]
    for one, two in zip(packed.unpack(packed.pack(*arrays)), arrays, strict=True):
        assert one.dtype == two.dtype and (one == two).all()


# Benchmark decontamination ----------------------------------------------------------------


def windows_of(words, window):
    if not words:
        return set()
    size = min(window, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def contamination(texts, items, window):
    found = []
    for text in texts:
        words = alnum(text)
        hit, ids = set(), set()
        for item, item_text in items:
            for gram in windows_of(alnum(item_text), window):
                for i in range(len(words) - len(gram) + 1):
                    if tuple(words[i : i + len(gram)]) == gram:
                        hit.update(range(i, i + len(gram)))
                        ids |= {str(item)} - {"None"}
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found.append((len(words), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return found


def items_for(texts):
    long = alnum(texts[6])
    return [(1, " ".join(long[:30])), (10, " ".join(long[20:36])), (2, "one"), (2, "one"), (3, None),
            (4, "?!"), (None, " ".join(long[5:18])), (5, " ".join(long[3:8])), (6, "never seen words")]


@pytest.mark.parametrize("blocks", [1, 3])
def test_contamination_equals_brute_force(spark, odd, monkeypatch, blocks):
    texts = odd_texts()
    items = items_for(texts)
    if blocks > 1:
        monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 150)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(odd, benchmark).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == contamination(texts, items, 13)
    kept = decontaminate.decontaminate(odd, benchmark)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.contaminated}


def test_contamination_without_rows(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.contamination(odd, none).collect()
    assert len(rows) == odd.count() and not any(r.n_hit or r.contaminated for r in rows)
    assert decontaminate.contamination(odd.limit(0), none).count() == 0


def test_columns_with_clashing_names_stay(spark):
    rows = [(1, "a b", "x", 7, [1], 1.5)]
    names = "doc_id long, text string, hits string, n_words long, items array<int>, _hits double"
    frame = spark.createDataFrame(rows, names)
    benchmark = spark.createDataFrame([(1, "c")], "item_id long, text string")
    assert decontaminate.decontaminate(frame, benchmark).collect() == frame.collect()


# Substring dedup --------------------------------------------------------------------------


def repeats(rows, window):
    first = {}
    for doc, text in rows:
        words = spaced(text)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i : i + window])
            if doc is not None:
                first[gram] = min(doc, first.get(gram, doc))
    out = []
    for doc, text in rows:
        words = spaced(text)
        gone = set()
        for i in range(len(words) - window + 1):
            if doc is not None and first[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def test_repeats_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PER_COPY", 2)
    rows = [(i, t) for i, t in enumerate(odd_texts(2))]
    rows += [(None, rows[6][1]), (3, rows[7][1]), (3, rows[7][1]), (90, rows[-1][1])]
    random.Random(0).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in substring_dedup.repeats(frame).collect()]
    assert sorted(found, key=repr) == repeats(rows, 13)
    assert substring_dedup.repeats(frame.limit(0)).count() == 0


def test_automaton_knows_first_documents():
    rng = random.Random(4)
    passages = [[rng.choice(b"abc") for _ in range(rng.randrange(1, 30))] for _ in range(20)]
    automaton = substring_dedup.Automaton()
    for doc, passage in enumerate(passages):
        automaton.add(passage, doc)
    text = [rng.choice(b"abc") for _ in range(200)]
    for window in (1, 3, 6):
        found = automaton.first_docs(text, window)
        for i in range(len(text)):
            gram = text[i - window + 1 : i + 1] if i >= window - 1 else None
            holds = [
                d for d, p in enumerate(passages) if gram
                and any(p[k : k + window] == gram for k in range(len(p) - window + 1))
            ]
            assert found[i] == min(holds, default=-1)


# N-gram Jaccard join ----------------------------------------------------------------------


def groups(texts, shingle, percent):
    sets = []
    for text in texts:
        words = spaced(lower(text))
        grams = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
        sets.append(grams if words else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for gram in own for j in holders[gram])
        for j, both in shared.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for gram in own:
            holders[gram].append(i)
    return [(len(own), root(i)) for i, own in enumerate(sets)]


def near_copies(seed):
    """Groups of near copies whose edits are partly the same."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = odd_texts(seed)
    for size in (3, 25, 90):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 60, 150]))]
        shared = [rng.choice(vocabulary) for _ in range(4)]
        for k in range(size):
            words = list(texts[-1].split()) if k % 4 == 3 else list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
                at, kind = rng.randrange(len(words)), rng.random()
                new = rng.choice(shared if rng.random() < 0.6 else vocabulary)
                if kind < 0.5:
                    words[at] = new
                elif kind < 0.75:
                    del words[at]
                else:
                    words.insert(at, new)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("shingle", "percent"), [(4, 85), (5, 80)])
def test_groups_equal_brute_force(spark, shingle, percent):
    texts = near_copies(shingle)
    rows = jaccard_join.similar_groups(documents(spark, texts), shingle, percent).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    wanted = groups(texts, shingle, percent)
    assert [found[i] for i in range(len(texts))] == wanted


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f g", "A b c d e f g", None, "", "x y z", "x y z", "p q r s t u v w"]
    frame = documents(spark, texts)
    again = frame.filter("doc_id = 6").withColumn("doc_id", frame.doc_id * 0 + 6)
    kept = jaccard_join.one_of_each(frame.unionByName(again))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4, 6]
    assert jaccard_join.one_of_each(frame.limit(0)).count() == 0


def test_rows_without_an_id_are_compared(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "k l m n o"), (None, "k l m n o")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similar_groups(frame).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == [(4, 4), (None, 4), (None, None), (None, None)]
    assert len(jaccard_join.one_of_each(frame).collect()) == 2


# Scores under a language model --------------------------------------------------------------


def lm_scores(texts, order):
    docs = [alnum(t) for t in texts]
    counts = [Counter() for _ in docs]
    for own, words in zip(counts, docs, strict=True):
        for n in range(1, order + 1):
            own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    whole = sum(counts, Counter())
    n_all = sum(map(len, docs))
    out = []
    for own, words in zip(counts, docs, strict=True):
        total = 0.0
        for i in range(len(words)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                c = whole[gram] - own[gram]
                if c > 0:
                    below = whole[gram[:-1]] - own[gram[:-1]] if n > 1 else n_all - len(words)
                    total += math.log(factor * c / below)
                    break
                if n > 1:
                    factor *= lm_score.BACKOFF
            else:
                total += math.log(factor / (n_all - len(words) + 1))
        out.append((len(words), total))
    return out


@pytest.mark.parametrize("order", [1, 3])
def test_lm_scores_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 200)
    texts = [t for t in odd_texts(5) if t is None or len(t) < 5000] + ["only here"]
    rows = lm_score.scores(documents(spark, texts), order).orderBy("doc_id").collect()
    for row, (n, total) in zip(rows, lm_scores(texts, order), strict=True):
        assert row.n_words == n and row.log_score == pytest.approx(total, abs=1e-6)
        assert row.word_score == (pytest.approx(total / n) if n else None)
    assert lm_score.scores(documents(spark, texts).limit(0)).count() == 0
