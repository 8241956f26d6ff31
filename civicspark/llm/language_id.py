"""Language identification by compression: the dictionary that shortens a text most names it.

Each language gets a zstandard raw-content dictionary of whole sample texts.  Letters are lower-cased
and what is no letter in ASCII becomes a space, so that layout does not count.  A text is cut into
pieces of ``PIECE`` bytes, so that a long text does not come to predict itself, and every piece is
compressed with every dictionary.  The language with the fewest bytes over all pieces wins; the
margin is the share of bytes it saves against the second.  Where the margin is below ``min_margin``
the choice is rejected.

The sample has ``TEXTS`` texts a language, those with the smallest hash, texts of up to
``LONGEST`` bytes before longer ones; a dictionary has ``DICTIONARY`` bytes at most.  These bounds
do not depend on the size of the corpus.  Everything else covers whole texts and all rows.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is
everything if nothing could be learned.  Ties go to the language with more rows to learn from."""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.llm.frames import fresh, named

UNKNOWN = "und"
TEXTS = 96
LONGEST = 16 << 10
DICTIONARY = 112 << 10
PIECE = 2048
LEVEL = 6
#: Margin from which the score is 1.
SURE = 0.08

#: Texts of up to ``SHORT`` bytes get a thorougher search.
SHORT = 512
SHORT_LEVEL = 12

_LETTER = regex.compile(r"\p{L}")
_SPACES = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def _letters(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_SPACES).split())


def sample_texts(documents: DataFrame, usable: Column, text: str, lang: str) -> dict[str, list[str]]:
    """Sample texts of every language, at most ``TEXTS`` each; languages with most rows first."""
    rows = documents.filter(usable & named(lang).isNotNull() & (F.octet_length(named(text)) > 0))
    keyed = rows.select(
        named(lang).alias("lang"),
        (F.octet_length(named(text)) > LONGEST).alias("long"),
        F.xxhash64(named(text)).alias("key"),
    )
    order = Window.partitionBy("lang").orderBy("long", "key")
    chosen = (
        keyed.distinct()
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= TEXTS)
        .select("lang", "key", "rank")
    )
    # bounded by TEXTS rows a language
    found = (
        rows.select(
            named(lang).alias("lang"),
            F.xxhash64(named(text)).alias("key"),
            F.left(named(text), F.lit(DICTIONARY)).alias("text"),
        )
        .join(F.broadcast(chosen), ["lang", "key"])
        .groupBy("lang", "rank")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", "rank")
        .collect()
    )
    counts = rows.groupBy(named(lang).alias("lang")).count().collect()
    out: dict[str, list[str]] = {
        r["lang"]: [] for r in sorted(counts, key=lambda r: (-r["count"], r["lang"]))
    }
    for row in found:
        out[row["lang"]].append(row["text"])
    return out


def dictionary(texts: list[str]) -> bytes:
    """Texts joined, the first nearest to the end, where a dictionary is cheapest to refer to."""
    return b" ".join(_letters(t) for t in reversed(texts))[-DICTIONARY:]


class Compressors:
    """Two compressors a language, for ordinary and for short pieces."""

    def __init__(self, contents: dict[str, bytes]) -> None:
        self.langs = list(contents)
        self.tools = self._compressors(contents, LEVEL, PIECE)
        self.short = self._compressors(contents, SHORT_LEVEL, SHORT)

    def _compressors(self, contents: dict[str, bytes], level: int, size: int) -> list:
        shape = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=size, dict_size=DICTIONARY,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        tools = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(
                contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(compression_params=shape)
            tools.append(zstandard.ZstdCompressor(dict_data=content, compression_params=shape))
        return tools

    def name(self, text: str | None) -> tuple[str, float]:
        """The nearest language and the margin."""
        if not self.tools or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0
        data = _letters(text)
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        tools = self.tools if len(data) > SHORT else self.short
        sizes = [sum(len(t.compress(p)) for p in pieces) for t in tools]
        least = min(sizes)
        best = sizes.index(least)
        second = min((s for i, s in enumerate(sizes) if i != best), default=None)
        return self.langs[best], 1.0 if second is None else (second - least) / second


def identify(
    documents: DataFrame, learn: Column, min_margin: float = 0.01, text: str = "text",
    lang: str = "lang",
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``documents`` with three more columns, whose names are returned too: the language (``und``
    where the margin is too narrow), the nearest language whatever the margin, and a score from 0
    to 1.  Languages are learned from the rows that ``learn`` marks."""
    spark = documents.sparkSession
    contents = {k: dictionary(v) for k, v in sample_texts(documents, learn, text, lang).items()}
    sent = spark.sparkContext.broadcast(contents)
    names = fresh(documents, "language", "nearest", "certainty")
    schema = documents.select(
        "*", F.lit("").alias(names[0]), F.lit("").alias(names[1]), F.lit(0.0).alias(names[2])
    ).schema

    def name_all(batches):
        tools = Compressors(sent.value)
        for batch in batches:
            found = [tools.name(t.as_py()) for t in batch.column(text)]
            nearest = [n for n, _ in found]
            sure = [n if margin >= min_margin else UNKNOWN for n, margin in found]
            score = [min(1.0, margin / SURE) for _, margin in found]
            columns = [pa.array(sure), pa.array(nearest), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], [*batch.schema.names, *names]
            )

    return documents.mapInArrow(name_all, schema), tuple(names)


def crc32_fold(column: str, folds: int) -> Column:
    """crc32 of the column's text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def predictions(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and narrow of every document."""
    fold = F.coalesce(crc32_fold("doc_id", 4), F.lit(0))
    rows = documents.select("doc_id", "text", "lang", (fold == 2).alias("held_out"))
    found, (language, nearest, score) = identify(rows, ~F.col("held_out"))
    return found.select(
        "doc_id",
        "held_out",
        named(nearest).alias("lang_pred"),
        named(score).alias("score"),
        (named(language) != named(nearest)).alias("narrow"),
    )
