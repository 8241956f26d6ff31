"""Toxicity of texts whose noise is undone first by a noisy-channel decoder.

Decoding.  Words with leetspeak, letters spelled out one by one, and drawn-out letters become a
character lattice: every place offers the letters it may stand for (or none), each at a price, and
every gap may end a word or not.  Viterbi search under a character trigram model and the usual words,
both learned from the texts, finds the cheapest reading.  Clean words have a single reading and are
left as they are.  When texts are scored, lattices without any reading that a rule could cover are not
searched, which changes no score.

Scoring.  A word, as written or as restored, is telling by itself or by its first letters (six to
three).  Learning goes from the particular to the general: first whole words, then ever shorter
beginnings, each judged only by words that no earlier rule covers, so that a beginning is not
blamed for one bad word.  A rule must hold in mostly toxic texts, more often than chance among as
many candidates would bring; words that defy a rule on beginnings become exceptions.  The evidence
of a text is the sum of the log odds of the rules that hold, and a logistic curve fitted to the
labelled texts turns it into the score.

Copies and near copies among the labelled texts (whose three smallest hashes of words are the same)
count as one text, or the words of a toxic text that is often copied would all be rules.

Learning takes all labelled rows that ``learn`` marks, and whole texts; rows without a label are
passed over before they are decoded, by a bitmap of hashes of the labelled ids.  The character model and the
usual words, which need no label, come from all texts that ``learn`` marks.  What is counted stays in Spark;
the driver gets the character model, the parts frequent enough to become rules, and the rules.  Texts
are not shuffled for it, only their different words are.  Scoring covers whole texts and all rows.

Defined results: null, empty and word-less texts get the score of a text without features; if
the labels have one class only, everything gets that class's score (0 or 1), and 0 if there are none.
Rows with a null doc_id or label are not learned from."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import cut, fresh, named
from civicspark.llm.language_id import crc32_fold
from civicspark.llm.tokens import CHUNK, slices, text_bytes

#: Size of the decoder's model: character triples and words that it knows, at most, those that are the
#: most frequent in all texts to learn from.
TRIPLES = 60_000
WORDS = 30_000
#: Different parts that a task counts before it hands them on.
_COUNTED = 200_000
#: Arrays of at least as many words whose different words are handed on together.
_HELD = 10
#: Numbers above this one are not told apart when the least number of a frequent part is looked for.
_FREQUENT = 50_000
#: Bits of the bitmap of labelled ids: for each label, and at most.  With more labels more rows pass it
#: that have none; they are dropped by the join.
_BITS_EACH, _BITS_MOST = 16, 1 << 27
#: Fixed by Spark's bitmap functions.
_BUCKET_BITS = 1 << 15
#: Types of ids that are equal only if their hashes are.
_HASHED = ("tinyint", "smallint", "int", "bigint", "string")
_CODEC = pa.Codec("zstd", 1)
#: First letters of a word that may be a rule, longest first.
HEADS = (6, 5, 4, 3)

# fixed values: what a character may stand for in leetspeak
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
#: Rules that chance may bring, on average, at each length.
CHANCE = 0.3

_PRICE_LEET, _PRICE_DROP, _PRICE_WILD = 0.7, 12.0, 2.0
#: Price of a character that is no sign, and of one that may be punctuation at the end of a word.
_PRICE_OTHER = 0.5
#: Prices of reading a drawn-out letter once, twice, or as written.
_PRICE_RUN = {1: 0.2, 2: 0.9}
_PRICE_AS_IS = 4.0
#: Readings followed at each place of a lattice.
_WIDTH = 48
#: Words that the character model is learned from are no longer.
_LONGEST = 24
#: Tokens whose readings are remembered are no longer.
_REMEMBERED = 64

_SIGNS = "0123456789@$!|+(€"
_SIGNED = re.compile(rf"(?<!\S)[^\s{_SIGNS}*]*+[{_SIGNS}*]\S*+")
_DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
_SPELLED_OUT = re.compile(
    rf"(?<!\S)(?:(?:[^\W\d_]|[{_SIGNS}])[ .\-_*]){{2,}}(?:[^\W\d_]|[{_SIGNS}])(?!\w)"
)
_HEAD = re.compile(r"^[\W_]+(?<![@$!|+(€])")
_LETTERS = re.compile(r"[^\W\d_]")
_SOUNDS = re.compile(rf"[^\W\d_]|[{_SIGNS}]")
_SPACES = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))

#: By code point, the last one for all beyond (ideographs, which have no case): small letters, the
#: two small sigmas as one, and whether the regexes above take it for a letter, a sign or a gap.
_SMALL = np.array([ord(chr(c).lower()[0]) for c in range(0x20000)] + [0], np.uint32)
_SMALL[ord("ς")] = ord("σ")
_IS_LETTER = np.array([chr(c).isalnum() and not chr(c).isdecimal() for c in range(0x20000)] + [True])
_IS_WORD = np.array([chr(c).isalnum() for c in range(0x20000)] + [True])
_IS_SIGN = np.array([chr(c) in _SIGNS for c in range(0x20000)] + [False])
_IS_GAP = np.array([chr(c) in " .-_*" for c in range(0x20000)] + [False])
_IS_SPACE = np.array([chr(c) in " \t\n\r\f\v" for c in range(0x20000)] + [False])
#: Kinds of noise a text may have.
LEETSPEAK, DRAWN, SPELLED = 1, 2, 4


def _points(own: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8, and the ends of texts counted in them."""
    if own.max() < 128:
        return own, ends
    before = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
    return np.frombuffer(own.tobytes().decode().encode("utf-32-le"), np.uint32), before[ends]


def noise(column: pa.Array) -> np.ndarray:
    """For every text, the kinds of noise it may have, from its characters: all that the regexes find
    in the lower-cased text, and somewhat more.  Only texts that may have some are searched word by
    word, which takes far longer."""
    data, offsets = text_bytes(column)
    kinds = np.zeros(len(offsets) - 1, np.int64)
    for part in slices(column, CHUNK):
        own = data[offsets[part.start] : offsets[part.stop]]
        if len(own) < 2:
            continue
        own, ends = _points(own, offsets[part.start + 1 : part.stop + 1] - offsets[part.start])
        known = own.astype(np.intp)
        beyond = known >= len(_SMALL) - 1
        known[beyond] = len(_SMALL) - 1
        letter = _IS_LETTER[known]
        small = np.where(beyond, own, _SMALL[known])
        # nothing goes on from one text to the next
        within = np.ones(len(own) - 1, bool)
        within[ends[(ends > 0) & (ends < len(own))] - 1] = False
        # nor after the one letter whose small form is a letter and a mark
        joined = within & (own[:-1] != ord("İ"))
        word = _IS_WORD[known]
        alone = letter | _IS_SIGN[known]
        alone[1:] &= ~(word[:-1] & joined)
        alone[:-1] &= ~(word[1:] & joined)
        gap = _IS_GAP[known]
        same = joined & letter[:-1] & letter[1:] & (small[1:] == small[:-1])
        sign, black = _IS_SIGN[known] | (own == ord("*")), ~_IS_SPACE[known]
        found = (
            (LEETSPEAK, np.flatnonzero(within & (sign[:-1] & black[1:] | black[:-1] & sign[1:]))),
            (DRAWN, np.flatnonzero(same[1:] & same[:-1])),
            (SPELLED, np.flatnonzero(
                alone[4:] & gap[3:-1] & alone[2:-2] & gap[1:-3] & alone[:-4]
            )),
        )
        for kind, at in found:
            kinds[part.start + np.unique(np.searchsorted(ends, at, "right"))] |= kind
    return kinds


def plain_words(text: str) -> set[str]:
    """Distinct words of letters, lower-cased."""
    return set(text.lower().encode().translate(_SPACES).decode().split())


def _spelling(link: tuple | None) -> str:
    """The text of a reading, which is kept as its last letters and the reading before them."""
    parts: list[str] = []
    while link is not None:
        link, letters = link
        parts.append(letters)
    return "".join(reversed(parts))


class CharacterModel:
    """Prices of a letter after two others, and of the usual words."""

    def __init__(self, triples: dict[str, int], words: dict[str, int] | None = None) -> None:
        pairs: Counter[str] = Counter()
        for triple, n in triples.items():
            pairs[triple[:2]] += n
        self.letters = sorted({t[2] for t in triples} - {"$"})
        size = max(1, len(self.letters)) + 1
        self.price_of = {
            t: -math.log((n + 0.1) / (pairs[t[:2]] + 0.1 * size)) for t, n in triples.items()
        }
        self.unseen = {p: -math.log(0.1 / (n + 0.1 * size)) for p, n in pairs.items()}
        self.unknown = math.log(size) + 1
        # as many words begin as the triples count
        total = sum(n for t, n in triples.items() if t.startswith("^^"))
        self.words = {w: math.log(max(total, n) / n) for w, n in (words or {}).items()}
        self.beginnings = {w[:i] for w in self.words for i in range(1, len(w) + 1)}

    def price(self, before: str, letter: str) -> float:
        found = self.price_of.get(before + letter)
        return self.unseen.get(before, self.unknown) if found is None else found

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """Readings of every place of the token, with their prices; a space ends a word."""
        places: list[list[tuple[str, float]]] = []
        at = 0
        while at < len(token):
            c = token[at]
            run = 1
            while at + run < len(token) and token[at + run] == c:
                run += 1
            if c == " ":
                options = [("", 0.0), (" ", 0.0)]
            elif _LETTERS.match(c):
                options = [(c * k, _PRICE_RUN[k]) for k in (1, 2)] if run > 1 else [(c, 0.0)]
                if run > 2:
                    options.append((c * run, _PRICE_AS_IS))
                elif run == 2:
                    options = [(c * 2, 0.0), (c, 8.0)]
            elif c in LEET or c == "*":
                options = [(letter * k, _PRICE_LEET * k) for letter in LEET.get(c, "") for k in
                           ((1, 2) if run > 1 else (1,))]
                if c == "*":
                    options += [(letter, _PRICE_WILD) for letter in self.letters]
                ends = c == "*" or (c in "!|+(" and at and at + run == len(token))
                options.append(("", _PRICE_OTHER if ends else _PRICE_DROP))
            else:
                options = [("", _PRICE_OTHER), (" ", _PRICE_OTHER)]
            places.append(options)
            at += run
        return places

    def _whole_words(self, places: list, ends: set[int], at: int, cost: float, link, out: dict) -> None:
        """Adds to ``out``, by the end of the word, the cheapest reading that goes on with a usual
        word from the place ``at`` on."""
        front = {"": cost}
        while front and at < len(places):
            after: dict[str, float] = {}
            for begun, so_far in front.items():
                for letters, price in places[at]:
                    if letters == " " or (not letters and price == _PRICE_DROP):
                        continue
                    longer = begun + letters
                    if (not longer or longer in self.beginnings) and (
                        so_far + price < after.get(longer, math.inf)
                    ):
                        after[longer] = so_far + price
            front, at = after, at + 1
            if at in ends:
                for word, so_far in front.items():
                    if word in self.words:
                        found = so_far + self.words[word]
                        if at not in out or found < out[at][0]:
                            out[at] = found, (link, word)

    def restore(self, token: str, places: list | None = None) -> str:
        """The cheapest reading of the token, words apart."""
        places = self.lattice(token) if places is None else places
        ends = {i for i, options in enumerate(places) if options[-1][0] == " "} | {len(places)}
        readings: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        price_of, unseen, unknown = self.price_of, self.unseen, self.unknown
        whole: dict[int, tuple[float, tuple]] = {}
        self._whole_words(places, ends, 0, 0.0, None, whole)

        def ended(at: int) -> tuple[float, tuple | None] | None:
            """The cheapest reading whose last word ends before the place."""
            found = [
                (cost + self.price(state, "$"), state, link)
                for state, (cost, link) in readings.items() if state != "^^"
            ]
            best = min(found, key=lambda f: f[:2], default=None)
            if at in whole and (best is None or whole[at][0] <= best[0]):
                return whole[at]
            return best and (best[0], best[2])

        for at, options in enumerate(places):
            after: dict[str, tuple[float, tuple | None]] = {}
            for before, (cost, link) in readings.items():
                for letters, price in options:
                    if letters == " ":
                        continue
                    total, state = cost + price, before
                    for letter in letters[:3]:
                        # as ``price``, without a call for each
                        step = price_of.get(state + letter)
                        total += unseen.get(state, unknown) if step is None else step
                        state = state[1] + letter
                    if len(letters) > 3:
                        total += (len(letters) - 3) * self.price(state, letters[-1])
                    if state not in after or total < after[state][0]:
                        after[state] = total, (link, letters) if letters else link
            if options[-1][0] == " ":
                best = ended(at)
                if best is not None:
                    cost, link = best[0] + options[-1][1], (best[1], " ")
                    if "^^" not in after or cost < after["^^"][0]:
                        after["^^"] = cost, link
                    self._whole_words(places, ends, at + 1, cost, link, whole)
            readings = after
            if len(after) > _WIDTH:
                readings = dict(sorted(after.items(), key=lambda kv: (kv[1][0], kv[0]))[:_WIDTH])
        best = ended(len(places))
        # a reading without letters, or one that ends in a gap
        if "^^" in readings and (best is None or readings["^^"][0] < best[0]):
            best = readings["^^"]
        return _spelling(best and best[1])


def _may_begin(places: list[list[tuple[str, float]]], heads: set[str]) -> bool:
    """Whether a word of any reading is in ``heads``, or has its first three letters there."""
    for start in range(len(places)):
        if start and places[start - 1][-1][0] != " ":
            continue
        front, at = {""}, start
        while front:
            if at == len(places) or places[at][-1][0] == " ":
                if front & heads:
                    return True
                front.discard("")  # the same as to start after the gap
            if at == len(places):
                break
            front = {begun + letters for begun in front for letters, _ in places[at] if letters != " "}
            if any(begun[:3] in heads for begun in front if len(begun) > 2):
                return True
            front = {begun for begun in front if len(begun) < 3}
            at += 1
    return False


def _bare_end(token: str, signs: str) -> str:
    """The token without what follows its last letter, digit or sign."""
    end = len(token)
    while end and not token[end - 1].isalnum() and token[end - 1] not in signs:
        end -= 1
    return token[:end]


class Decoder:
    """Restored words of texts; readings already found are remembered, up to a limit.  With ``heads``,
    only tokens that may be read as words of these first letters are decoded."""

    def __init__(self, model: CharacterModel, heads: set[str] | None = None) -> None:
        self.model, self.heads = model, heads
        self.known: dict[tuple[str, bool], tuple[str, ...]] = {}

    def _tokens(self, text: str, kinds: int) -> set[tuple[str, bool]]:
        """Tokens that may be disguised, and whether they are spelled out."""
        found: set[tuple[str, bool]] = set()
        if kinds & SPELLED:
            for m in _SPELLED_OUT.finditer(text):
                letters = m.group()[::2]
                found.update(((letters, True), (" ".join(letters), True)))
        if kinds & LEETSPEAK:
            found.update((token, False) for token in _SIGNED.findall(text))
        if kinds & DRAWN:
            found.update((token, False) for token in set(text.split()) if _DRAWN_OUT.search(token))
        return found

    def _words(self, token: str, spelled: bool) -> tuple[str, ...]:
        if spelled:
            readable = [token]
        else:
            # signs after the last letter or digit may be punctuation, or letters
            bare = _HEAD.sub("", token)
            readable = [
                t for t in {_bare_end(bare, ""), _bare_end(bare, "*" + _SIGNS)}
                if _DRAWN_OUT.search(t) or (
                    (signed := sum(map(t.count, "*" + _SIGNS)))
                    and _SOUNDS.search(t) and signed + len(_LETTERS.findall(t)) > 1
                )
            ]
        out: set[str] = set()
        for t in readable:
            places = self.model.lattice(t)
            if self.heads is None or _may_begin(places, self.heads):
                out.update(self.model.restore(t, places).split())
        return tuple(sorted(w for w in out if len(w) > 1))

    def restored(self, text: str, kinds: int) -> set[str]:
        """Readings of the words with noise of the given kinds."""
        out: set[str] = set()
        for key in self._tokens(text.lower(), kinds) if kinds else ():
            words = self.known.get(key)
            if words is None:
                words = self._words(*key)
                if len(key[0]) <= _REMEMBERED:
                    if len(self.known) > 100_000:
                        self.known.clear()
                    self.known[key] = words
            out.update(words)
        return out


def _part(word: str, head: int) -> str | None:
    """The whole word (0) or its first letters."""
    if not head:
        return word
    return f"{word[:head]}-" if len(word) > head else None


def _rule_of(word: str, rules: dict[str, float]) -> str | None:
    """The most particular rule on the word."""
    for head in (0, *HEADS):
        part = _part(word, head)
        if part in rules:
            return part
    return None


def _first_letters(rules: Iterable[str]) -> set[str]:
    """The first three letters, or fewer, of all words that a rule covers.  Most words have others,
    which is found faster than whether a rule covers them."""
    return {part.removesuffix("-")[:3] for part in rules}


def _evidence(parts: set[str], rules: dict[str, float]) -> float:
    return sum(math.log(rules[p] / (1 - rules[p])) for p in sorted(parts) if rules[p])


def _curve(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (evidence, toxic, number), by Newton's method
    with a small ridge."""
    total = sum(n for _, _, n in points)
    slope, offset = 1.0, -2.0
    for _ in range(50):
        g0 = g1 = h01 = 0.0
        g1 -= 0.01 * (slope - 1)
        h00, h11 = 1e-6 * total, 0.01 + 1e-6 * total
        for z, toxic, n in points:
            share = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * z + offset))))
            gap, bend = n * (toxic - share), n * share * (1 - share)
            g0, g1 = g0 + gap, g1 + gap * z
            h00, h01, h11 = h00 + bend, h01 + bend * z, h11 + bend * z * z
        area = h00 * h11 - h01 * h01
        move = (h11 * g0 - h01 * g1) / area, (h00 * g1 - h01 * g0) / area
        offset += max(-2.0, min(2.0, move[0]))
        slope = max(0.05, slope + max(-0.5, min(0.5, move[1])))
    return slope, offset


def _triples(words: Iterable[str] | dict[str, int]) -> Counter:
    """Character triples of the words, as often as each word counts."""
    weights = words if isinstance(words, dict) else Counter(words)
    used = [word for word in weights if len(word) <= _LONGEST]
    if not used:
        return Counter()
    lengths = np.fromiter(map(len, used), np.int64, len(used)) + 3
    own = np.frombuffer("".join(f"^^{word}$" for word in used).encode("utf-32-le"), np.uint32)
    own = own.astype(np.uint64)
    # a word's last two places begin no triple
    ends = np.cumsum(lengths)
    begins = np.ones(len(own), bool)
    begins[ends - 1] = begins[ends - 2] = False
    at = np.flatnonzero(begins)
    keys, which = np.unique(own[at] << 42 | own[at + 1] << 21 | own[at + 2], return_inverse=True)
    of_words = np.fromiter((weights[word] for word in used), np.int64, len(used))
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, which, np.repeat(of_words, lengths - 2))
    parts = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF], 1).astype(np.uint32)
    text = parts.tobytes().decode("utf-32-le")
    return Counter({text[3 * i : 3 * i + 3]: n for i, n in enumerate(sums.tolist())})


def _tail(bad: int, n: int, share: float) -> float:
    """Probability of ``bad`` or more of ``n`` by chance."""
    logs = [
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        + k * math.log(share) + (n - k) * math.log1p(-share)
        for k in range(bad, n + 1)
    ]
    return sum(map(math.exp, logs))


class Model:
    """Shares by rule (0 for exceptions), slope and offset of the score, the character model and the
    usual words."""

    def __init__(
        self, rules: dict[str, float], curve: tuple[float, float], triples: dict[str, int],
        words: dict[str, int],
    ) -> None:
        self.rules, self.curve, self.triples, self.words = rules, curve, triples, words

    def scorer(self):
        heads = _first_letters(part for part, share in self.rules.items() if share)
        decoder = Decoder(CharacterModel(self.triples, self.words), heads)
        rules, (slope, offset) = self.rules, self.curve

        def score(text: str | None, kinds: int) -> float:
            parts: set[str | None] = set()
            if text:
                for words in (plain_words(text), decoder.restored(text, kinds)):
                    # an exception begins as the rule it is from
                    parts.update([_rule_of(word, rules) for word in words if word[:3] in heads])
                parts.discard(None)
            z = slope * _evidence(parts, rules) + offset
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def _counted(parts: pa.Array, numbers: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([parts.cast(pa.string()), numbers], ["part", "n"])


def _smallest(words: list[bytes]) -> str:
    """The three smallest hashes of words."""
    hashes, found = set(map(zlib.crc32, words)), []
    for _ in range(min(3, len(hashes))):
        found.append(min(hashes))
        hashes.remove(found[-1])
    return " ".join(map(str, found))


def _packed(text: bytes) -> bytes:
    """Different words of a text, a space apart, in a short form; they are shuffled and stored."""
    return len(text).to_bytes(8, "little") + _CODEC.compress(text, asbytes=True)


def _unpacked(packed: bytes) -> list[str]:
    """The different words."""
    length = int.from_bytes(packed[:8], "little")
    return _CODEC.decompress(packed[8:], length, asbytes=True).decode().split()


def _counting(words: DataFrame, parts_of: Callable) -> DataFrame:
    """In how many toxic (``bad``) and other (``good``) texts each part occurs; ``parts_of`` makes a
    function from a text's words to its different parts, once in every task."""

    def handed_on(bad: Counter, good: Counter) -> pa.RecordBatch:
        parts = list(bad.keys() | good.keys())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(parts, pa.string()),
                pa.array([bad[p] for p in parts], pa.int64()),
                pa.array([good[p] for p in parts], pa.int64()),
            ],
            ["part", "bad", "good"],
        )

    def count(batches):
        parts, bad, good = parts_of(), Counter(), Counter()
        for batch in batches:
            marks = batch.column("toxic").to_pylist()
            for own, toxic in zip(batch.column("words"), marks, strict=True):
                (bad if toxic else good).update(parts(_unpacked(own.as_py())))
                if len(bad) + len(good) > _COUNTED:
                    yield handed_on(bad, good)
                    bad, good = Counter(), Counter()
        yield handed_on(bad, good)

    counted = words.select("toxic", "words").mapInArrow(count, "part string, bad long, good long")
    return counted.groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _covered(rules: Iterable[str]) -> Callable[[list[str]], set[str]]:
    """A function that finds the words that a rule covers."""
    left, heads = _uncovered(rules), _first_letters(rules)

    def covered(words: list[str]) -> set[str]:
        likely = {word for word in words if word[:3] in heads}
        return likely - left(likely)

    return covered


def _uncovered(rules: Iterable[str]) -> Callable[[set[str]], set[str]]:
    """A function that takes the words out that a rule covers."""
    whole = {p for p in rules if not p.endswith("-")}
    begun = {head: {p[:head] for p in rules if p.endswith("-") and len(p) == head + 1} for head in HEADS}
    begun = {head: heads for head, heads in begun.items() if heads}

    def left(words: set[str]) -> set[str]:
        words = words - whole
        for head, heads in begun.items():
            words = {w for w in words if len(w) <= head or w[:head] not in heads}
        return words

    return left


def _parts_left(rules: Iterable[str], head: int, among: Iterable[str] | None) -> Callable:
    """The parts, of those ``among``, of words that no rule covers."""
    left = _uncovered(rules)
    whole = None if among is None else set(among)
    heads = None if among is None else {p[:head] for p in among}

    def parts(words: list[str]) -> set[str]:
        if not head:
            return left(set(words) if whole is None else whole.intersection(words))
        if heads is None:
            longer = {w for w in words if len(w) > head}
        else:
            longer = {w for w in words if w[:head] in heads and len(w) > head}
        return {f"{w[:head]}-" for w in left(longer)}

    return parts


def _new_rules(words: DataFrame, head: int, rules: dict[str, float], usual: float) -> dict[str, float]:
    """Rules on words (``head`` 0) or on their first letters, judged by the words that no rule covers."""
    context = words.sparkSession.sparkContext
    known = context.broadcast(set(rules))
    tried = cut(
        _counting(words.filter("toxic = 1"), lambda: _parts_left(known.value, head, None))
        .filter("bad > 1")
        .select("part", "bad")
    )
    number = tried.count()
    # A part in n toxic texts is by chance at least as probable as n toxic texts out of n, so those
    # in fewer than these cannot become rules.
    least = 2
    while number * usual**least >= CHANCE:
        least += 1
    likely = dict(map(tuple, tried.filter(F.col("bad") >= least).collect()))
    wanted = context.broadcast(set(likely))
    others = dict(
        map(
            tuple,
            _counting(
                words.filter("toxic = 0"), lambda: _parts_left(known.value, head, wanted.value)
            ).select("part", "good").collect(),
        )
    )
    found = {}
    for part, n in likely.items():
        other = others.get(part, 0)
        if n > other and _tail(n, n + other, usual) * number < CHANCE:
            found[part] = (n + 0.5) / (n + other + 1)
    return found


def _whole_shares(words: DataFrame, rules: dict[str, float]) -> dict[str, float]:
    """Shares of the rules on beginnings over all words that begin so, but for the exceptions.  They
    were chosen by the words that nothing more particular covers, which may be few."""
    sent = words.sparkSession.sparkContext.broadcast(rules)

    def parts_of():
        heads = {p for p, share in sent.value.items() if p.endswith("-") and share}
        exceptions = {p for p, share in sent.value.items() if not share}

        letters = _first_letters(heads)

        def parts(words: list[str]) -> set[str]:
            left = {w for w in words if w[:3] in letters} - exceptions
            return {f"{w[:head]}-" for head in HEADS for w in left if len(w) > head} & heads

        return parts

    return {
        p: max(rules[p], (bad + 0.5) / (bad + good + 1))
        for p, bad, good in _counting(words, parts_of).filter("bad > 0").collect()
    }


def _exceptions(words: DataFrame, rules: dict[str, float]) -> dict[str, float]:
    """Words that a rule on beginnings covers but that mostly occur in texts that are not toxic."""
    sent = words.sparkSession.sparkContext.broadcast(set(rules))

    def parts_of():
        covered, rules = _covered(sent.value), sent.value
        return lambda words: covered(words) - rules

    found = _counting(words, parts_of).filter("good > 1 AND good > bad")
    return {row["part"]: 0.0 for row in found.select("part").collect()}


def _most(counted: DataFrame, most: int) -> dict[str, int]:
    """The most frequent parts.  How frequent they are at least is found first, or every task would
    send the driver as many."""
    least, seen = 1, 0
    numbers = counted.groupBy(F.least("n", F.lit(_FREQUENT)).alias("n")).count().collect()
    for n, parts in sorted(map(tuple, numbers), reverse=True):
        least, seen = n, seen + parts
        if seen >= most:
            break
    found = counted.filter(F.col("n") >= least).select("part", "n").collect()
    return dict(sorted(map(tuple, found), key=lambda f: (-f[1], f[0]))[:most])


def _character_model(rows: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """The usual character triples and words of all texts, with the numbers of texts (of words, for
    triples) they are in."""

    def handed_on(words: list[pa.Array]) -> Iterable[pa.RecordBatch]:
        found = pc.value_counts(pa.chunked_array(words, pa.string()))
        own, numbers = found.field("values"), found.field("counts")
        short = pc.less_equal(pc.utf8_length(own), _LONGEST)
        own, numbers = own.filter(short), numbers.filter(short)
        triples = _triples(dict(zip(own.to_pylist(), numbers.to_pylist(), strict=True)))
        yield _counted(pa.array(list(triples), pa.string()), pa.array(list(triples.values()), pa.int64()))
        # words after a space, which no triple holds
        yield _counted(pc.binary_join_element_wise(pa.scalar(""), own, " "), numbers)

    def count(batches):
        held: list[pa.Array] = []
        words: list[str] = []
        for batch in batches:
            for text in batch.column("text"):
                words.extend(plain_words(text.as_py() or ""))
                if len(words) > _COUNTED:
                    held.append(pa.array(words, pa.string()))
                    words = []
                    if len(held) == _HELD:
                        yield from handed_on(held)
                        held = []
        yield from handed_on([*held, pa.array(words, pa.string())])

    is_word = F.col("part").startswith(" ")
    summed = rows.select("text").mapInArrow(count, "part string, n long").groupBy("part")
    usual = cut(summed.agg(F.sum("n").alias("n")).filter(~is_word | (F.col("n") > 1)))
    words = usual.filter(is_word).select(F.substring("part", 2, _LONGEST).alias("part"), "n")
    return _most(usual.filter(~is_word), TRIPLES), _most(words, WORDS)


def _marked_places(documents: DataFrame, marked: DataFrame) -> tuple[Column, np.ndarray]:
    """A place per doc_id, and a bitmap of the places of the ``marked`` ones.  Others may share their
    places, and all ids do if those of the two tables cannot be compared by hashes."""
    key = documents.schema["doc_id"].dataType
    if marked.schema["doc_id"].dataType != key or key.simpleString() not in _HASHED:
        return F.lit(0).cast("long"), np.full(1, 255, np.uint8)
    needed = max(_BUCKET_BITS, marked.count() * _BITS_EACH)
    size = min(_BITS_MOST, 1 << (needed - 1).bit_length())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    # Spark's positions begin at 1
    maps = marked.groupBy(F.bitmap_bucket_number(place + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("bits")
    )
    bits = np.zeros(size // 8, np.uint8)
    width = _BUCKET_BITS // 8
    for bucket, found in maps.collect():
        bits[(bucket - 1) * width : bucket * width] = np.frombuffer(found, np.uint8)
    return place, bits


def fit(documents: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """A model from all labelled rows that ``learn``, over doc_id, marks."""
    spark = documents.sparkSession
    learned_from = learn & F.col("doc_id").isNotNull()
    labelled = labels.filter(learned_from & F.col("toxic").isin(0, 1))
    marks = labelled.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = documents.select("doc_id", "text").filter(learned_from)
    triples, usual_words = _character_model(rows)
    place, bits = _marked_places(documents, labelled)
    sent = spark.sparkContext.broadcast((triples, usual_words, bits))

    def words_of(batches):
        *usual, marked = sent.value
        decoder = Decoder(CharacterModel(*usual))
        for batch in batches:
            at = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((marked[at >> 3] >> (at & 7) & 1).astype(bool)))
            found, sizes, keys = [], [], []
            column = batch.column("text").cast(pa.string())
            for text, kinds in zip(column, noise(column), strict=True):
                value = text.as_py() or ""
                own = plain_words(value) | decoder.restored(value, int(kinds))
                joined = " ".join(sorted(own)).encode()
                found.append(_packed(joined))
                sizes.append(len(own))
                keys.append(_smallest(joined.split()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(keys, pa.string()),
                    pa.array(sizes, pa.int32()),
                    pa.array(found, pa.binary()),
                ],
                ["doc_id", "alike", "n_words", "words"],
            )

    key = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, alike string, n_words int, words binary"
    words = rows.withColumn("place", place).mapInArrow(words_of, schema)
    # Nearly as many labels as texts: to broadcast them would take the more memory the larger the corpus.
    words = words.join(marks.hint("merge"), "doc_id")
    # of texts alike the one with most words, ties by the words themselves
    most_words = F.max(F.struct("n_words", "words")).alias("most")
    words = cut(words.groupBy("toxic", "alike").agg(most_words).select("toxic", "most.words"))
    sizes = {r["toxic"]: r["count"] for r in words.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Model({}, (1.0, 30.0 if bad else -30.0), triples, usual_words)
    usual = bad / (bad + good)
    rules: dict[str, float] = {}
    for head in (0, *HEADS):
        rules |= _new_rules(words, head, rules, usual)
    rules |= _exceptions(words, rules)
    rules |= _whole_shares(words, rules)
    learned = spark.sparkContext.broadcast(rules)

    def evidence(batches):
        rules, covered = learned.value, _covered(learned.value)
        for batch in batches:
            found = []
            for text in batch.column("words"):
                parts = {_rule_of(w, rules) for w in covered(_unpacked(text.as_py()))}
                found.append(round(_evidence(parts, rules), 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.float64())], ["toxic", "z"]
            )

    points = words.mapInArrow(evidence, "toxic int, z double").groupBy("z", "toxic").count()
    curve = _curve([(r["z"], r["toxic"], r["count"]) for r in points.orderBy("z", "toxic").collect()])
    return Model(rules, curve, triples, usual_words)


def score(documents: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with one more column, whose name is returned too: the score."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    (name,) = fresh(documents, "toxicity")

    def score_all(batches):
        one = sent.value.scorer()
        for batch in batches:
            column = batch.column(text).cast(pa.string())
            kinds = noise(column)
            found = [one(t.as_py(), int(k)) for t, k in zip(column, kinds, strict=True)]
            found = pa.array(found, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    schema = documents.select("*", F.lit(0.0).alias(name)).schema
    return documents.mapInArrow(score_all, schema), name


def scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    fold = F.coalesce(crc32_fold("doc_id", 5), F.lit(0))
    model = fit(documents, labels, fold != 0)
    found, name = score(documents.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (fold == 0).alias("held_out"),
        named(name).alias("score"),
        (named(name) >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that are not predicted to be toxic."""
    found, name = score(documents, fit(documents, labels, F.lit(True)))
    return found.filter(named(name) < 0.5).select(*[named(c) for c in documents.columns])
