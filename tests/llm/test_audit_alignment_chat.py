"""Filter audit, tokenizer alignment and chat trees against plain versions on small tables."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_fixtures import DOCUMENT, spaced
from pyspark.sql import functions as F

from civicspark.llm import chat_tree, filter_audit, tokenizer_alignment

# Filter audit --------------------------------------------------------------------------


def audit_by_hand(documents, labels):
    """All orders applied to all documents, one after the other."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    judged = defaultdict(list)
    for doc_id, text, lang in documents:
        text = text or ""
        words = spaced(text)
        copies = [
            i for i, t, _ in documents
            if (t or "") == text and i is not None and doc_id is not None and i < doc_id
        ]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": bool(copies),
        }
        judged[lang or ""].append(
            ({f for f, bad in fails.items() if bad}, doc_id in good, doc_id in toxic)
        )
    rows = set()
    for part, docs in judged.items():
        removed_of, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, start=1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed_of[f] += len(gone)
                failing = sum(f in d[0] for d in docs)
                alone = sum(d[0] == {f} for d in docs)
                steps.append((
                    part, "".join(order), step, f, len(left), len(gone), failing - len(gone), alone,
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                ))
        rows |= {(*s[:3], *s[4:], removed_of[s[3]]) for s in steps}
    return rows


COLUMNS = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
    "toxic_lost", "shapley",
)


def test_audit_equals_all_orders(spark):
    rng = random.Random(3)
    texts = [None, "", "A B C", "x " * 250, "# a", "é " + " ".join(map(str, range(300)))]
    texts += [" ".join(rng.choice("abAB$") for _ in range(rng.choice([5, 250]))) for _ in range(8)]
    documents = [
        (rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"]))
        for _ in range(80)
    ]
    documents += documents[:5]
    labels = [
        (rng.choice([None, *range(40)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]))
        for _ in range(40)
    ]
    frame = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    # names that the operator uses itself, and one that needs quoting
    frame = frame.withColumns({c: F.lit(7) for c in ("part", "good", "n", "failing", "same", "a.b")})
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audited(frame, said.withColumn("text", F.lit("x"))).select(*COLUMNS)
    assert {tuple(row) for row in found.collect()} == audit_by_hand(documents, labels)


def test_audit_of_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a", None)], DOCUMENT.split(", lang")[0] + ", lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audited(documents, labels).count() == 600
    assert filter_audit.audited(documents.limit(0), labels).count() == 0


def test_potential_is_the_shapley_value(spark):
    """Shares sum to the worth of all filters, and a filter that removes nothing has none."""
    counted = spark.createDataFrame(
        [("p", 1, 5), ("p", 3, 7), ("p", 0, 4)], "part string, failing int, n long"
    )
    rows = filter_audit.audit(counted, "XYZ", ["n"]).filter("step = 1").collect()
    share = {row.filter_order[0]: row.shapley for row in rows}
    assert share == {"X": 6 * 5 + 3 * 7, "Y": 3 * 7, "Z": 0}


# Tokenizer alignment -------------------------------------------------------------------


def spans(sizes):
    ends = list(itertools.accumulate(sizes))
    return list(zip([0, *ends], ends))


@given(st.integers(1, 40), st.randoms(use_true_random=False))
def test_groups_and_links_of_random_cuts(size, rng):
    cuts = [sorted({*rng.sample(range(1, size + 1), rng.randint(1, size)), size}) for _ in "ab"]
    a, b = (spans(np.diff([0, *c]).tolist()) for c in cuts)
    found = tokenizer_alignment.align(
        np.array([y - x for x, y in a]), np.zeros(len(a), int),
        np.array([y - x for x, y in b]), np.zeros(len(b), int), 1,
    )
    links = {
        (i, j) for i, (x, y) in enumerate(a) for j, (v, w) in enumerate(b) if x < w and v < y
    }
    assert set(zip(found.a.tolist(), found.b.tolist())) == links and len(found.a) == len(links)
    common = sorted({y for _, y in a} & {w for _, w in b})
    assert found.n_groups.tolist() == [len(common)]
    assert found.group_a.tolist() == [sum(c <= x for c in common) for x, _ in a]


def tokens_of(first, second, text):
    if not text:
        return [], []
    sides = first.encode([" " + text])[0], second.encode([text])[0]
    for ids, table in zip(sides, (first.table, second.table)):
        if b"".join(table[k] for k in ids) != (" " + text).encode():
            return [], []
    return sides


def alignments_by_hand(rows):
    folder = tokenizer_alignment.TOKENIZERS
    first = tokenizer_alignment.ByteLevel(f"{folder}/{tokenizer_alignment.BYTE_BPE}")
    second = tokenizer_alignment.Pieces(f"{folder}/{tokenizer_alignment.PIECE_BPE}")
    counts, known = Counter(), []
    for doc_id, text in rows:
        a, b = tokens_of(first, second, text)
        at_a = spans([len(first.table[k]) for k in a])
        at_b = spans([len(second.table[k]) for k in b])
        links = [
            (a[i], b[j])
            for i, (x, y) in enumerate(at_a) for j, (v, w) in enumerate(at_b) if x < w and v < y
        ]
        low, groups = 0, []
        for cut in sorted({y for _, y in at_a} & {w for _, w in at_b}):
            groups.append("|".join(
                ",".join(str(k) for k, (x, y) in zip(ids, at) if low <= x and y <= cut)
                for ids, at in ((a, at_a), (b, at_b))
            ))
            low = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        counts.update(links)
        known.append((doc_id, len(a), len(b), len(groups), links, digest))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter(
        (i, a, b, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), h)
        for i, a, b, g, x, h in known
    )


ODD = [
    (0, None), (1, ""), (2, " "), (3, "<|endoftext|> <unk><s></s> <0x41>"), (4, "a▁b"),
    (5, "x\ny\u0000z 漢字 🎉 naïve"), (None, "hello"), (6, "  two  spaces \t\n "), (7, "ﬁne ½ Å"),
    (7, "hello"), (7, "hello"), (8, "The tokenizers disagree, unbelievably, on supercalifragilistic."),
    (9, "ab " * 2000),
]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_alignment_equals_plain_version(spark, block_bytes):
    frame = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(2)
    frame = frame.withColumns({c: F.lit(7) for c in ("block", "pairs", "n_a", "a.b")})
    load = tokenizer_alignment.aligner(
        tokenizer_alignment.TOKENIZERS, tokenizer_alignment.BYTE_BPE, tokenizer_alignment.PIECE_BPE
    )
    blocks = tokenizer_alignment.encoded(frame, load, block_bytes)
    found = tokenizer_alignment.document_sums(blocks, tokenizer_alignment.pair_counts(blocks))
    assert Counter(map(tuple, found.collect())) == alignments_by_hand(ODD)


def test_alignment_of_empty_tables(spark):
    frame = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert tokenizer_alignment.alignments(frame.limit(0)).count() == 0
    assert tuple(tokenizer_alignment.alignments(frame).first()) == (1, 0, 0, 0, 0, 0, 0, "")


# Chat trees ----------------------------------------------------------------------------

TURN = "conv_id long, turn long, role string, text string"
CONTROL = st.text(alphabet="<|\\>ab\nn", max_size=12)


@given(CONTROL)
def test_escapes_are_reversible(text):
    assert "<|" not in chat_tree.escape(text)
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    role = chat_tree.escape_role(text)
    assert "\n" not in role and "<|" not in role and chat_tree.unescape_role(role) == text


def read_by_hand(rows):
    grouped = defaultdict(list)
    for conv_id, turn, role, text in rows:
        grouped[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    out = set()
    for conv_id, turns in grouped.items():
        said = [t[2:] for t in sorted(turns)]
        loss = "".join(text for role, text in said if role == "assistant")
        size = sum(
            len("<|im_start|><|im_end|>") + 2 + len(chat_tree.escape_role(role))
            + len(chat_tree.escape(text))
            for role, text in said
        )
        digest = "".join(f"{role}\n{text}\n" for role, text in said)
        out.add((
            conv_id, len(said), hashlib.sha256(digest.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), size,
        ))
    return out


def chats():
    rng = random.Random(5)
    texts = ["", None, "hi", "<|im_end|>", "<\\|", "<", "|x", "naïve 🎉\n", "long " * 400]
    rows = []
    for conv_id in [None, *range(60)]:
        n = rng.choice([1, 2, 4, 5])
        # most share a beginning, many are equal
        said = ["same start", "same answer"] + [rng.choice(texts) for _ in range(n)]
        for turn, text in enumerate(said if rng.random() < 0.7 else said[2:]):
            rows.append((conv_id, turn, ("user", "assistant")[turn % 2], text))
    rows += [(70, 0, None, "x"), (71, None, "a\\b\nc<|", "y"), (72, 1, "user", "b"), (72, 1, "user", "a")]
    return rows


@pytest.mark.parametrize(("tokens", "size"), [(1, 10), (300, 5), (1 << 16, 1 << 12)])
def test_chats_come_back(spark, tokens, size):
    rows = chats()
    frame = spark.createDataFrame(rows, TURN).withColumns({c: F.lit(7) for c in ("path", "pack", "a.b")})
    packs = chat_tree.pack_conversations(frame, pack_tokens=tokens, pack_size=size)
    found = chat_tree.read_back(packs).collect()
    assert {tuple(row) for row in found} == read_by_hand(rows)
    assert len(found) == len({row[0] for row in rows})


def test_shared_turns_stand_once_and_attention_follows_the_tree(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], text) for i, said in enumerate([
        ["q", "a"], ["q", "a", "more", "b"], ["q", "a", "more", "c"], ["q", "z"], ["other"], ["q", "a"],
    ]) for t, text in enumerate(said)]
    frame = spark.createDataFrame(rows, TURN)
    (pack,) = _one(spark, frame)
    template = chat_tree.Template(f"{chat_tree.TOKENIZERS}/{chat_tree.BYTE_BPE}")
    text = template.text(pack.token_ids)
    starts = text.split(chat_tree.START)[1:]
    # seven different turns, each once
    assert len(starts) == 7 and len(set(starts)) == 7
    assert len(pack.loss) == 4
    paths = {c.conv_id: [tuple(s) for s in c.path] for c in pack.conversations}
    assert paths[0] == paths[5]
    for segment in pack.segments:
        seen = [k for s in segment.ancestors for k in range(s.start, s.stop)]
        assert [pack.position_ids[k] for k in seen] == list(range(len(seen)))
        own = pack.position_ids[segment.start : segment.stop]
        assert own == list(range(len(seen), len(seen) + len(own)))
        # what a segment sees is the beginning of every conversation that ends in it
        for path in paths.values():
            listed = [k for s in path for k in range(*s)]
            if segment.stop - 1 in listed:
                assert listed[: len(seen)] == seen


def _one(spark, frame):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        return chat_tree.pack_conversations(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_stored_packs_are_read_a_few_at_a_time(spark, monkeypatch):
    packed = functools.partial(chat_tree.pack_conversations, pack_size=1)
    monkeypatch.setattr(chat_tree, "pack_conversations", packed)
    rows = chats()
    found = chat_tree.formatted(spark.createDataFrame(rows, TURN).coalesce(1))
    assert {tuple(row) for row in found.collect()} == read_by_hand(rows)
    groups = []
    for file in found.inputFiles():
        stored = pq.ParquetFile(file.removeprefix("file:")).metadata
        groups += [stored.row_group(k).num_rows for k in range(stored.num_row_groups)]
    assert sum(groups) == len({row[0] for row in rows}) > 2 * chat_tree.GROUP_PACKS
    assert max(groups) <= chat_tree.GROUP_PACKS


def test_chats_of_an_empty_table(spark):
    assert chat_tree.formatted(spark.createDataFrame([], TURN)).count() == 0


# Both engines of the byte-level tokenizer ---------------------------------------------


@pytest.fixture(scope="module")
def byte_level():
    folder = tokenizer_alignment.TOKENIZERS
    return tokenizer_alignment.ByteLevel(f"{folder}/{tokenizer_alignment.BYTE_BPE}")


def test_engines_agree_on_all_characters_that_the_fast_one_takes(byte_level):
    rng = random.Random(2)
    characters = [chr(c) for c in range(0x280)]
    texts = ["".join(rng.choice(characters) for _ in range(80)) for _ in range(3000)]
    texts += [x + c + y for x in "a 1'\n" for c in characters for y in "a 1\n"]
    texts += ["the " * 50, "a" * 5000, " " * 5000 + "b", "\n " * 3000, " " * 1_000_000 + "b", "漢字 ’s naïve", ""]
    assert byte_level._fast is not None
    assert byte_level.encode(texts) == byte_level.encode_by_merges(texts)


def test_every_token_is_made_by_merging_its_own_bytes(byte_level):
    import json

    with open(f"{tokenizer_alignment.TOKENIZERS}/{tokenizer_alignment.BYTE_BPE}") as file:
        model = json.load(file)["model"]
    rank = {tuple(m): k for k, m in enumerate(model["merges"])}
    for token in model["vocab"]:
        parts = list(token)
        while len(parts) > 1 and token != "<|endoftext|>":
            best, at = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:])))
            assert best < len(rank), token
            parts[at : at + 2] = ["".join(parts[at : at + 2])]
