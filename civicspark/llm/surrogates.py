"""Personal data replaced by surrogates: keyed, of the same type, distinct and repeatable.

Found are e-mail addresses, phone, card, account and social security numbers, IP addresses, access
keys, values after words like ``password=``, and names after forms of address.

The surrogate is the entity under a keyed permutation that keeps every character's class (digit,
vowel, consonant, hexadecimal digit in keys) and script and leaves separators, length and case
as they are: a Feistel network over the two halves of the entity, whose round values come from SHA-256
of key, type and the other half.  Kept is what makes the type: country codes, top-level domains,
forms of address, the last letter of names (and so their gender), and whether a card's check digit
is right.  Mail domains and the single names of a person get surrogates of their own, so that
addresses of one domain, and members of a family, stay recognisable as such.

Case and separators do not count: ``A@B.org`` and ``a@b.org``, ``(012) 555-0199`` and ``012 555 0199``
are one entity, whose surrogate takes the form of each mention.  Within a document, later mentions of
a person by one name alone are replaced as in the full name.  Names have any number of parts, among
them initials, and small words like ``von``, which stay.

The distinct entities of the corpus are checked: two entities must not share a surrogate, and no
surrogate may be an entity of the corpus.  Offenders are drawn again until none is left.  Only rows
with entities meet the table of surrogates; the others pass through.

Everything is SQL functions.  Defined results: null texts stay null and have no entities; other
columns are untouched; repeated rows get equal results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import cut, fresh, named

# fixed values: forms of address, by the gender they state
_MEN = "Mr|Mister|Sir|Herr|Herrn|M|Monsieur|Sr|Señor|Don|господин|κύριος"
_WOMEN = "Mrs|Ms|Miss|Madam|Frau|Mme|Mlle|Madame|Sra|Srta|Señora|Doña|госпожа|κυρία"
_ANYONE = "Dr|Prof"
_FORMS = rf"(?:{_MEN}|{_WOMEN}|{_ANYONE})\.?[ ](?:(?:{_ANYONE})\.?[ ])*+"
# fixed values: small words within names
_PARTICLES = (
    "von|vom|van|der|den|dem|de|del|della|dei|di|da|das|do|dos|du|des|la|las|le|los|lo|zu|zum|zur|ten|ter|"
    "te|af|av|bin|ibn|bint|al|el|y|e"
)
_SMALL = rf"(?:(?:{_PARTICLES})[ ])*+"
#: Initials, and names with what is joined to them in small letters.
_INITIALS = rf"(?:\p{{Lu}}\.){{2,}}+|\p{{Lu}}\.?(?=[ ]{_SMALL}\p{{Lu}})|(?![IA])\p{{Lu}}(?![\p{{L}}\p{{N}}'’-])"
_NAME = r"(?:[dl]['’]|[ae]l-)?+\p{Lu}[\p{L}'’-]"
_NAMES = rf"{_SMALL}(?:\p{{Lu}}\.(?=[ ]{_SMALL}\p{{Lu}})|(?:\p{{Lu}}\.){{2,}}+|{_NAME}*+)(?:[ ]{_SMALL}(?:{_NAME}++|{_INITIALS}))*+"

#: The types in the order in which they are tried at a place of the text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*\.\p{L}{2,}+",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "secret": r"(?i:(?<![\p{L}\p{N}])(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)[\p{L}\p{N}_/+-]{6,}+",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}+])(?:\d{13,19}+|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,4}+|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\p{L}\p{N}]|[.-]\d)|(?<![\p{L}\p{N}+])\+\d{9,14}(?!\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_FORMS}{_NAMES}",
}
ANY = "|".join(PATTERNS.values())
#: What of a match is left as it is, at its beginning.
KEPT = {
    "key": r"^(?:AKIA|ASIA)",
    "secret": r"^(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?",
    "iban": r"^[A-Z]{2}",
    "phone": r"^\+\d{1,3}(?=[ .(-])",
    "name": rf"^{_FORMS}",
}
ROUNDS = 4
#: Draws until a keyed number stands in for an entity all of whose surrogates are taken.
MOST_DRAWS = 24
#: Characters that are permuted together; longer parts are permuted piece by piece.
LONGEST = 128

# fixed values: the alphabets whose characters stand for each other
_LATIN = ("aeiouy", "bcdfghjklmnpqrstvwxz")
_CYRILLIC = ("аеиоуыэюя", "бвгджзклмнпрстфхцчшщ")
_GREEK = ("αεηιουω", "βγδζθκλμνξπρστφχψ")
_ACCENTED = ("àáâãäåèéêëìíîïòóôõöùúûüýæøœ", "çñß")
ALPHABETS = ("0123456789", *_LATIN, *_CYRILLIC, *_GREEK, *_ACCENTED)
_HEX = "0123456789abcdef"


def entity_type(match: Column) -> Column:
    """The first type whose pattern the whole match fits."""
    found = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        found = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(found)
    return found


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _stream(seed: Column, n: Column) -> Column:
    """``n`` numbers from 0 to 65535, from SHA-256."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(n / 16).cast("int")),
        lambda i: F.sha2(F.concat_ws("|", seed, i.cast("string")), 256),
    )
    return _let(
        F.array_join(blocks, ""),
        lambda digits: F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.conv(F.substring(digits, i * 4 - 3, F.lit(4)), 16, 10).cast("int"),
        ),
    )


def _moved(half: Column, sizes: Column, seed: Column) -> Column:
    """The half's numbers, each moved within its alphabet."""
    paired = F.zip_with(half, _stream(seed, F.size(half)), lambda v, k: v + k)
    return F.when(F.size(half) == 0, half).otherwise(F.zip_with(paired, sizes, lambda v, n: v % n))


def _permuted_numbers(values: Column, sizes: Column, seed: Column) -> Column:
    """A keyed permutation of arrays of numbers, each below its size."""
    middle = F.floor(F.size(values) / 2).cast("int")

    def step(state: Column, turn: Column) -> Column:
        one = F.concat_ws("|", seed, turn.cast("string"), F.lit("l"), F.array_join(state["right"], ","))
        new = _moved(state["left"], state["ls"], one)
        half = F.struct(
            new.alias("left"), state["right"].alias("right"), state["ls"].alias("ls"),
            state["rs"].alias("rs"),
        )

        def other(s: Column) -> Column:
            two = F.concat_ws("|", seed, turn.cast("string"), F.lit("r"), F.array_join(s["left"], ","))
            return F.struct(
                s["left"].alias("left"),
                _moved(s["right"], s["rs"], two).alias("right"),
                s["ls"].alias("ls"),
                s["rs"].alias("rs"),
            )

        return _let(half, other)

    start = F.struct(
        F.slice(values, F.lit(1), middle).alias("left"),
        F.slice(values, middle + 1, F.size(values) - middle).alias("right"),
        F.slice(sizes, F.lit(1), middle).alias("ls"),
        F.slice(sizes, middle + 1, F.size(sizes) - middle).alias("rs"),
    )
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return _let(done, lambda d: F.concat(d["left"], d["right"]))


def _alphabet(letter: Column, alphabets: tuple[str, ...]) -> Column:
    """The alphabet of a small letter or digit; empty for other characters."""
    found = F.lit("")
    for alphabet in alphabets:
        found = F.when(F.instr(F.lit(alphabet), letter) > 0, F.lit(alphabet)).otherwise(found)
    return found


def permuted(text: Column, seed: Column, alphabets: tuple[str, ...] = ALPHABETS) -> Column:
    """The text with every letter and digit moved within its alphabet, case kept.  Texts of more than
    ``LONGEST`` characters are moved in pieces of as many; the whole text decides on each piece."""
    last = F.floor((F.length(text) - 1) / LONGEST).cast("int")
    whole = F.sha2(F.lower(text), 256)
    pieces = F.when(
        F.length(text) > LONGEST,
        _let(
            whole,
            lambda w: F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.struct(
                    F.substring(text, i * LONGEST + 1, F.lit(LONGEST)).alias("text"),
                    F.concat_ws("|", seed, w, i.cast("string")).alias("seed"),
                ),
            ),
        ),
    ).otherwise(F.array(F.struct(text.alias("text"), seed.alias("seed"))))
    return F.array_join(
        F.transform(pieces, lambda p: _permuted_piece(p["text"], p["seed"], alphabets)), ""
    )


def _permuted_piece(text: Column, seed: Column, alphabets: tuple[str, ...]) -> Column:
    def of(chars: Column) -> Column:
        # characters that can move: place, alphabet, and place in the alphabet
        places = F.transform(
            chars, lambda c, i: F.struct(i.alias("at"), _alphabet(F.lower(c), alphabets).alias("abc"),
                                         F.lower(c).alias("small"))
        )
        return _let(
            F.filter(places, lambda p: F.length(p["abc"]) > 0),
            lambda movable: F.when(F.size(movable) == 0, text).otherwise(
                _let(
                    _permuted_numbers(
                        F.transform(movable, lambda p: F.instr(p["abc"], p["small"]) - 1),
                        F.transform(movable, lambda p: F.length(p["abc"])),
                        seed,
                    ),
                    lambda numbers: _let(
                        F.map_from_arrays(
                            F.transform(movable, lambda p: p["at"]),
                            F.zip_with(
                                movable, numbers,
                                lambda p, n: F.substring(p["abc"], n + 1, F.lit(1)),
                            ),
                        ),
                        lambda new: F.array_join(
                            F.transform(
                                chars,
                                lambda c, i: _let(
                                    F.coalesce(F.try_element_at(new, i), c),
                                    lambda d: F.when(c != F.lower(c), F.upper(d)).otherwise(d),
                                ),
                            ),
                            "",
                        ),
                    ),
                )
            ),
        )

    return F.when(F.length(text) > 0, _let(F.split(text, ""), of)).otherwise(text)


def _digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check digit for the digits before it."""
    reverse = F.reverse(F.split(digits, ""))
    doubled = F.transform(
        reverse,
        lambda d, i: _let(
            d.cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
            lambda n: n - F.when(n > 9, 9).otherwise(0),
        ),
    )
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, b: a + b), F.lit(10))


def _card(core: Column, seed: Column) -> Column:
    """Permuted digits in the card's form; the last is as right or wrong as it was."""

    def of(digits: Column) -> Column:
        before = F.substring(digits, F.lit(1), F.length(digits) - 1)
        off = F.substring(digits, F.length(digits), F.lit(1)).cast("int") - _luhn(before)

        def build(new: Column) -> Column:
            number = F.concat(new, F.pmod(_luhn(new) + off, F.lit(10)).cast("string"))
            chars = F.split(core, "")
            return _let(
                number,
                lambda n: F.array_join(
                    F.transform(
                        chars,
                        lambda c, i: F.when(
                            c.rlike("[0-9]"),
                            F.substring(
                                n,
                                F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x.rlike("[0-9]"))),
                                F.lit(1),
                            ),
                        ).otherwise(c),
                    ),
                    "",
                ),
            )

        return _let(permuted(before, seed), build)

    return _let(_digits_only(core), of)


def _address(core: Column, seed: Column) -> Column:
    octets = F.transform(F.split(core, "[.]"), lambda o: o.cast("int"))
    return _let(
        _permuted_numbers(octets, F.transform(octets, lambda o: F.lit(256)), seed),
        lambda new: F.array_join(F.transform(new, lambda n: n.cast("string")), "."),
    )


def _mail(core: Column, seed: Column) -> Column:
    local = F.substring_index(core, "@", 1)
    domain = F.substring_index(core, "@", -1)
    top = F.substring_index(domain, ".", -1)
    rest = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    return F.concat(
        permuted(local, F.concat(seed, F.lit("|local"))), F.lit("@"),
        permuted(rest, F.concat(seed, F.lit("|domain"))), F.lit("."), top,
    )


def _names(core: Column, seed: Column) -> Column:
    """Every name by itself, its last letter kept; initials move, small words stay."""
    parts = F.split(core, " ")
    return F.array_join(
        F.transform(
            parts,
            lambda n: F.when(n.rlike(rf"^(?:{_PARTICLES})$"), n)
            .when((F.size(parts) > 1) & (F.length(n) == 1), permuted(n, seed))
            .otherwise(
                F.concat(
                    permuted(F.substring(n, F.lit(1), F.length(n) - 1), seed),
                    F.substring(n, F.length(n), F.lit(1)),
                )
            ),
        ),
        " ",
    )


def _kept(match: Column, kind: Column) -> Column:
    found = F.lit("")
    for name, pattern in KEPT.items():
        found = F.when(kind == name, F.regexp_extract(match, pattern, 0)).otherwise(found)
    return found


def _draw(table: DataFrame, key: str) -> DataFrame:
    """``table`` (match, kind, kept, core, attempt) with the surrogate and its canonical form."""
    seed = F.concat_ws("|", F.lit(key), "kind", F.col("attempt").cast("string"))
    core = F.col("core")
    hexadecimal = core.rlike("^[0-9a-f]{16,}$") & core.rlike("[0-9]")
    new = (
        F.when(F.col("kind") == "email", _mail(core, seed))
        .when(F.col("kind") == "ip", _address(core, seed))
        .when(F.col("kind") == "card", _card(core, seed))
        .when(F.col("kind") == "name", _names(core, seed))
        .when(hexadecimal, permuted(core, seed, (_HEX,)))
        .otherwise(permuted(core, seed))
    )
    # Only of what no alphabet covers, or what finds nothing free again and again, a keyed number
    # stands in.  A surrogate that happens to be the entity itself is drawn again like any other.
    moving = F.when(F.col("kind") == "email", F.regexp_replace(core, r"\.\p{L}+$", "")).otherwise(core)
    still = F.regexp_replace(F.lower(moving), f"[{''.join(ALPHABETS)}]+", "") == F.lower(moving)
    new = F.when(
        (still & (F.lower(core) == F.lower(new))) | (F.col("attempt") >= MOST_DRAWS),
        F.concat(F.lit("x"), F.substring(F.sha2(F.concat_ws("|", seed, core), 256), 1, 12)),
    ).otherwise(new)
    drawn = table.withColumn("new", new)
    return drawn.withColumn("surrogate", F.concat("kept", "new")).withColumn(
        "new_canonical", _canonical(F.col("kind"), F.col("kept"), F.col("new"))
    )


def _canonical(kind: Column, kept: Column, core: Column) -> Column:
    """What two mentions of one entity have in common."""
    return (
        F.when(kind.isin("card", "ssn"), _digits_only(core))
        .when(kind == "phone", F.concat(_digits_only(kept), F.lit(" "), _digits_only(core)))
        .when(kind == "iban", F.regexp_replace(F.concat(kept, core), " ", ""))
        .when(kind.isin("email", "name"), F.lower(core))
        .otherwise(core)
    )


def surrogate_table(matches: DataFrame, key: str) -> DataFrame:
    """``match, kind, surrogate`` for the distinct values of ``matches.match``, all checked."""
    match = F.col("match")
    table = matches.select("match").distinct().withColumn("kind", entity_type(match))
    table = table.withColumn("kept", _kept(match, F.col("kind")))
    core = F.substring(match, F.length("kept") + 1, F.length(match))
    table = (
        table.withColumn("core", core)
        .withColumn("canonical", _canonical(F.col("kind"), F.col("kept"), F.col("core")))
        .withColumn("attempt", F.lit(0))
    )
    table = cut(_draw(table, key))
    originals = table.select("kind", F.col("canonical").alias("new_canonical")).distinct()
    while True:
        pairs = table.select("kind", "canonical", "new_canonical").distinct()
        first = pairs.groupBy("kind", "new_canonical").agg(F.min("canonical").alias("first"))
        shared = pairs.join(first, ["kind", "new_canonical"]).filter("canonical != first")
        real = pairs.join(originals, ["kind", "new_canonical"], "left_semi")
        again = cut(
            shared.select("kind", "canonical").unionByName(real.select("kind", "canonical")).distinct()
        )
        if again.isEmpty():
            return table.select("match", "kind", "surrogate")
        marked = table.select("match", "kind", "kept", "core", "canonical", "attempt").join(
            again.withColumn("again", F.lit(1)), ["kind", "canonical"], "left"
        )
        table = cut(
            _draw(
                marked.withColumn("attempt", F.expr("attempt + coalesce(again, 0)")).drop("again"), key
            )
        )


def _mentions(alone: Column) -> Column:
    """What single names become, and the pattern that finds them: as they are written, or all in
    capitals.  A word in small letters is not taken for a name."""
    written = F.transform(alone, lambda n: F.struct(n["old"].alias("old"), n["new"].alias("new")))
    loud = F.transform(
        alone, lambda n: F.struct(F.upper(n["old"]).alias("old"), F.upper(n["new"]).alias("new"))
    )
    both = F.concat(written, loud)
    # Of equal names the first one counts; longer names are tried first.
    olds = F.array_distinct(F.transform(both, lambda n: n["old"]))
    first = F.transform(olds, lambda o: F.get(F.filter(both, lambda n: n["old"] == o), F.lit(0)))
    longest = F.sort_array(
        F.transform(olds, lambda o: F.struct(F.length(o).alias("n"), o.alias("old"))), asc=False
    )
    quoted = F.transform(longest, lambda o: F.concat(F.lit(r"\Q"), o["old"], F.lit(r"\E")))
    return F.struct(
        F.map_from_entries(first).alias("new"),
        F.concat(
            F.lit(r"((?<![\p{L}\p{N}])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}]))")
        ).alias("pattern"),
    )


def _replaced(piece: Column, known: Column) -> Column:
    """The text with all known names replaced in one pass, so that no surrogate is replaced again."""
    between = F.split(piece, known["pattern"], -1)
    found = F.regexp_extract_all(piece, known["pattern"], F.lit(0))
    swapped = _let(
        F.struct(between.alias("between"), found.alias("found")),
        lambda s: F.array_join(
            F.transform(
                s["between"],
                lambda text, i: F.concat(
                    text,
                    F.coalesce(F.try_element_at(known["new"], F.get(s["found"], i)), F.lit("")),
                ),
            ),
            "",
        ),
    )
    return F.when(F.size(F.map_keys(known["new"])) == 0, piece).otherwise(swapped)


def replace(
    documents: DataFrame, key: str, text: str = "text"
) -> tuple[DataFrame, tuple[str, str]]:
    """``documents`` with surrogates in the text, and two more columns, whose names are returned:
    the number of entities, and of each type, as a map."""
    count, kinds, found, row, news = fresh(
        documents, "n_entities", "entity_types", "found", "row", "news"
    )
    source = F.coalesce(named(text).cast("string"), F.lit(""))
    with_any = documents.withColumn(found, F.regexp_extract_all(source, F.lit(f"({ANY})"), F.lit(0)))
    with_any = cut(
        with_any.filter(F.size(found) > 0).withColumn(row, F.monotonically_increasing_id())
    )
    mentions = with_any.select(F.col(row).alias("row"), F.posexplode(found).alias("at", "match"))
    table = surrogate_table(mentions, key)
    by_row = (
        mentions.join(table, "match")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "surrogate", "kind", "match"))).alias(news))
    )
    joined = with_any.join(by_row, with_any[row] == by_row["row"])
    pieces = F.split(source, ANY, -1)
    # single names of the persons found, with what became of them
    persons = F.filter(F.col(news), lambda m: m["kind"] == "name")
    names = F.flatten(
        F.transform(
            persons,
            lambda m: F.zip_with(
                F.split(F.regexp_replace(m["match"], KEPT["name"], ""), " "),
                F.split(F.regexp_replace(m["surrogate"], KEPT["name"], ""), " "),
                lambda old, new: F.struct(
                    old.alias("old"), new.alias("new"),
                    F.regexp_replace(m["match"], KEPT["name"], "").alias("whole"),
                ),
            ),
        )
    )
    # neither small words nor initials name a person alone
    alone = F.filter(
        names, lambda n: ~n["old"].rlike(rf"^(?:{_PARTICLES}|\p{{Lu}}\.|\p{{Lu}})$") | (n["old"] == n["whole"])
    )
    spliced = _let(
        _mentions(alone),
        lambda known: F.array_join(
            F.transform(
                pieces,
                lambda piece, i: F.concat(
                    _replaced(piece, known),
                    F.coalesce(F.get(F.col(news), i)["surrogate"], F.lit("")),
                ),
            ),
            "",
        ),
    )
    types = F.transform(
        F.array_distinct(F.transform(F.col(news), lambda m: m["kind"])),
        lambda k: F.struct(k, F.size(F.filter(F.col(news), lambda m: m["kind"] == k))),
    )
    columns = documents.columns
    changed = joined.select(
        *[(spliced.alias(c) if c == text else named(c)) for c in columns],
        F.size(news).cast("long").alias(count),
        F.map_from_entries(types).alias(kinds),
    )
    others = documents.filter(~source.rlike(ANY)).select(
        *[named(c) for c in columns],
        F.lit(0).cast("long").alias(count),
        F.map_from_entries(F.array().cast("array<struct<k:string,n:int>>")).alias(kinds),
    )
    return changed.unionByName(others), (count, kinds)


def pseudonymised(documents: DataFrame, key: str) -> DataFrame:
    """doc_id, text with surrogates, n_entities and the number of each type, of every document."""
    found, (count, kinds) = replace(documents.select("doc_id", "text"), key)
    by_type = [
        F.coalesce(F.try_element_at(F.col(kinds), F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}")
        for k in PATTERNS
    ]
    return found.select("doc_id", "text", F.col(count).alias("n_entities"), *by_type)
