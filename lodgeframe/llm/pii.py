"""Personal data: base patterns, and contexts bootstrapped from them that find identifiers of other forms.

Everything is DataFrame expressions. The base matches are seeds. The words around them are lexical
patterns; patterns and the identifier-like strings they surround form a graph that is scored in rounds:
a pattern by the share of its slots that known identifiers fill, over all slots of the corpus; a string by
the patterns that surround it. Strings of high score become known, and their patterns count in the next round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.names import free_name
from lodgeframe.session import checkpointed

# The base patterns. Possessive repeats and the conditions at the start find the same matches
# as plain ones, in time in proportion to the text and without recursion for each repeat.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
FOUND = "id"

# What an identifier of unknown form may look like: 6 to 64 characters with a digit.
_PART = r"[A-Za-z0-9_@.+/-]"
_GLUE = r"[^A-Za-z0-9_@.+/\x20\x09-\x0D-]"  # what may stand between a candidate and the rest of its word
CANDIDATE = rf"(?<!{_PART})(?={_PART}*[0-9]){_PART}{{6,64}}+(?!{_PART})"

_BLOCK = 128  # matches whose places are added up together
_BLANK = r"[\x20\x09-\x0D]+"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) <= 3) & (F.lpad(value, 3, "0") <= "255")

    return F.forall(F.split(match, r"\."), small)


def _valid_card(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def add(total: Column, i: Column) -> Column:
        value = F.substring(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + value - F.when(value > 9, 9).otherwise(0)

    luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(16, 19), luhn).otherwise(False)


def _valid_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


def _always(match: Column) -> Column:
    return F.length(match) > 0


def _places(pieces: str, matches: str, valid: Callable[[Column], Column]) -> Column:
    """(start, end) of the valid matches in code points, from the matches and the pieces between them.

    Lengths are added up in blocks, so that many matches do not make the work grow with their square.
    """
    items = F.arrays_zip(F.slice(F.col(pieces), F.lit(1), F.size(matches)).alias("p"), F.col(matches).alias("m"))
    blocks = F.when(
        F.size(matches) > 0,
        F.transform(
            F.sequence(F.lit(0), ((F.size(matches) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(items, b * _BLOCK + 1, F.lit(_BLOCK)),
        ),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def inside(first: Column, block: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["p"])
            end = start + F.length(x["m"])
            more = F.array(F.struct(start.alias("start"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(valid(x["m"]), F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), add)

    def join(acc: Column, block: Column) -> Column:
        here = inside(acc["at"], block)
        return F.struct(here["at"].alias("at"), F.concat(acc["all"], F.array(here["out"])).alias("all"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("all"))
    return F.coalesce(F.flatten(F.aggregate(blocks, start, join)["all"]), none)


def _located(df: DataFrame, text: str, found: dict[str, tuple[str, Column, Callable[[Column], Column]]]) -> DataFrame:
    """Adds the places of each pattern: (pattern, what a text must have to be searched, which matches count)."""
    split = {f"_{k}_p": F.when(gate, F.split(text, pattern, -1)) for k, (pattern, gate, _) in found.items()}
    matched = {f"_{k}_m": F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))) for k, (pattern, gate, _) in found.items()}
    placed = {k: _places(f"_{k}_p", f"_{k}_m", valid) for k, (_, _, valid) in found.items()}
    return df.withColumns(split | matched).withColumns(placed).drop(*split, *matched)


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds email, ip, card and phone: arrays of (start, end), leftmost and not overlapping within a kind."""
    digits = F.col(text).rlike("[0-9]{2}|[0-9][ .-][0-9]")
    return _located(
        df,
        text,
        {
            "email": (EMAIL, F.col(text).contains("@"), _always),
            "ip": (IP, F.col(text).rlike(r"[0-9]\.[0-9]"), _valid_ip),
            "card": (CARD, digits, _valid_card),
            "phone": (PHONE, F.col(text).contains("+"), _valid_phone),
        },
    )


def _last(words: Column, n: int) -> Column:
    return F.coalesce(F.try_element_at(words, F.lit(-n)), F.lit(""))


def _patterns(left: Column, right: Column) -> Column:
    """Ids of the patterns around a slot: the two words before it, and the words on both sides."""
    before, after = F.split(F.rtrim(left), _BLANK), F.split(F.ltrim(right), _BLANK)
    one, two, next_ = _last(before, 1), _last(before, 2), F.coalesce(F.try_element_at(after, F.lit(1)), F.lit(""))
    return F.array(F.xxhash64(F.lit("left"), two, one), F.xxhash64(F.lit("both"), one, next_))


def _glued(word: Column, before: Column, next_: Column, reach: int) -> Column:
    """The same ids for every part of a word that could be a candidate next to other characters, as in ``id="x1"``.

    Only ``reach`` characters around a part make its context, so a long word costs in proportion to its length.
    """
    alone = F.array().cast("array<bigint>")
    joined = lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))

    def cut(word: Column) -> Column:
        pieces, parts = word["pieces"], word["parts"]

        def of(part: Column, i: Column) -> Column:
            # pairs of a piece and a part have a character at least, so ``reach`` of them are enough
            first = F.greatest(i - reach, F.lit(0))
            ahead = F.zip_with(F.slice(pieces, first + 1, i - first), F.slice(parts, first + 1, i - first), joined)
            after = F.zip_with(F.slice(parts, i + 2, F.lit(reach)), F.slice(pieces, i + 3, F.lit(reach)), joined)
            left = F.right(F.concat(F.array_join(ahead, ""), F.get(pieces, i)), F.lit(reach))
            right = F.left(F.concat(F.get(pieces, i + 1), F.array_join(after, "")), F.lit(reach))
            right = F.when(right != "", right)
            room = reach - 1 - F.length(left)
            two = F.when(room > 0, F.right(before, room)).otherwise(F.lit(""))
            inner = F.array(F.xxhash64(F.lit("left"), two, left), F.xxhash64(F.lit("both"), left, F.coalesce(right, next_)))
            # the first part of a word shares its left slot with the word
            outer = F.array(F.xxhash64(F.lit("both"), before, right))
            return F.when(left != "", inner).when(right.isNotNull(), outer).otherwise(alone)

        return F.flatten(F.transform(parts, of))

    # in an array of one, so that a word is cut once and not for each of its parts
    split = F.struct(
        F.split(word, f"{_PART}+", -1).alias("pieces"), F.regexp_extract_all(word, F.lit(f"{_PART}+"), F.lit(0)).alias("parts")
    )
    return F.flatten(F.transform(F.array(split), cut))


def _slots(words: str, reach: int = 80) -> Column:
    """The same ids for every word of a text, and for the parts of words that hold other characters."""
    at = lambda i: F.coalesce(F.get(F.col(words), i), F.lit(""))
    each = F.transform(
        F.col(words),
        lambda w, i: F.array(
            F.xxhash64(F.lit("left"), at(i - 2), at(i - 1)), F.xxhash64(F.lit("both"), at(i - 1), at(i + 1))
        ),
    )
    glued = F.transform(
        F.col(words),
        lambda w, i: F.when(w.rlike(_GLUE), _glued(w, at(i - 1), at(i + 1), reach)).otherwise(F.array().cast("array<bigint>")),
    )
    return F.concat(F.flatten(each), F.flatten(glued))


def occurrences(df: DataFrame, key: str, text: str, reach: int = 80) -> DataFrame:
    """(k, r, the base kinds, uses) of every row; ``uses``: base matches and candidates with value and patterns.

    ``r`` tells rows with equal keys and different texts apart. No text is carried.
    """
    rows = df.select(F.col(key).alias("k"), F.xxhash64(text).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    spans = base_spans(rows, "t")
    spans = _located(spans, "t", {"cand": (CANDIDATE, F.col("t").rlike("[0-9]"), _always)})
    seeds = F.concat(*(F.col(k) for k in BASE))
    fresh = F.filter(F.col("cand"), lambda c: ~F.exists(F.col("seeds"), lambda s: (c["start"] < s["end"]) & (s["start"] < c["end"])))

    def use(s: Column, seed: bool) -> Column:
        value = F.substring(F.col("t"), s["start"] + 1, s["end"] - s["start"])
        value = value if seed else F.rtrim(value, F.lit(".-+_@/"))
        low = F.greatest(s["start"] - reach, F.lit(0))
        left = F.lower(F.substring(F.col("t"), low + 1, s["start"] - low))
        right = F.lower(F.substring(F.col("t"), s["end"] + 1, F.lit(reach)))
        return F.struct(
            s["start"].alias("start"),
            (s["start"] + F.length(value)).alias("end"),
            F.xxhash64(value).alias("value"),
            F.lit(seed).alias("seed"),
            _patterns(left, right).alias("patterns"),
        )

    uses = F.concat(F.transform("seeds", lambda s: use(s, True)), F.transform("fresh", lambda s: use(s, False)))
    return (
        spans.withColumn("seeds", seeds).withColumn("fresh", fresh).select("k", "r", *BASE, uses.alias("uses"))
    )


def slot_counts(df: DataFrame, text: str, wanted: DataFrame, bits: int = 7 << 17) -> DataFrame:
    """(pattern, seen): how many words of the corpus stand in each wanted pattern's slot.

    A bit table of fixed size (``bits`` / 7 bytes, in the plan) keeps nearly all other slots from the count;
    what passes by chance goes with the join. However many patterns there are, only its bytes come to the driver.
    """
    place = F.pmod(F.col("pattern"), F.lit(bits)).cast("int")
    byte, bit = F.floor(place / 7).cast("int"), place % 7
    table = bytearray(bits // 7)
    for at, value in wanted.groupBy(byte).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), bit))).collect():
        table[at] = value
    held = F.ascii(F.substring(F.lit(bytes(table)), byte + 1, F.lit(1)).cast("string"))
    words = df.select(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _BLANK).alias("w"))
    slots = words.select(F.explode(_slots("w")).alias("pattern"))
    near = slots.where(F.call_function("shiftright", held, bit).bitwiseAND(F.lit(1)) == 1)
    return near.groupBy("pattern").agg(F.count("*").alias("seen")).join(wanted, "pattern", "left_semi")


def known_identifiers(
    uses: DataFrame,
    seen: DataFrame,
    rounds: int = 3,
    support: int = 3,
    pattern_share: float = 0.5,
    instance_score: float = 0.8,
) -> DataFrame:
    """(value, score) of the strings that are no base matches but stand where known identifiers stand.

    A pattern holds if known identifiers, ``support`` different ones at least, fill ``pattern_share`` of its
    slots. A string's score is 1 - product(1 - share) over the patterns that hold around it.
    """
    edges = checkpointed(
        uses.select(F.explode("patterns").alias("pattern"), "value", "seed")
        .groupBy("pattern", "value", "seed").agg(F.count("*").alias("n"))
        .join(seen, "pattern", "left")  # without a counted slot a pattern has its own uses
    )
    known = None
    for _ in range(rounds):
        sure = F.col("seed")
        marked = edges
        if known is not None:
            marked = edges.join(known.select("value", F.lit(True).alias("k")), "value", "left")
            sure = sure | F.coalesce("k", F.lit(False))
        filled = marked.groupBy("pattern").agg(
            F.count_if(sure).alias("different"),
            F.sum(F.when(sure, F.col("n")).otherwise(0)).alias("filled"),
            F.greatest(F.max("seen"), F.sum("n")).alias("slots"),
        )
        share = F.col("filled") / F.col("slots")
        # written, so that the next join can split a pattern with very many slots
        held = checkpointed(
            filled.where((F.col("different") >= support) & (share >= pattern_share)).select("pattern", share.alias("share"))
        )
        known = checkpointed(
            edges.where("NOT seed").join(held, "pattern").groupBy("value")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("share"), F.lit(0.99)))))).alias("score"))
            .where(F.col("score") >= instance_score)
        )
    return known


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text", **scoring) -> DataFrame:
    """(key, r, email, ip, card, phone, id): arrays of (start, end) in code points, one row for each row of ``df``.

    ``id`` has what the contexts found; it never overlaps a base match. Null texts have no spans. ``r`` is a
    hash of the text; rows that repeat a key are kept apart by it. Other columns are not carried.
    An empty table gives an empty result.
    """
    rows = checkpointed(occurrences(df, key, text))
    uses = rows.select("k", "r", F.explode("uses").alias("u")).select("k", "r", "u.*")
    support = scoring.get("support", 3)
    pairs = uses.select(F.explode("patterns").alias("pattern"), "value", "seed").distinct()
    often = pairs.groupBy("pattern").agg(F.count("*").alias("c"), F.count_if("seed").alias("s"))
    wanted = checkpointed(often.where((F.col("c") > F.col("s")) & (F.col("c") >= support)).select("pattern"))
    seen = checkpointed(slot_counts(df, text, wanted))
    known = known_identifiers(uses, seen, **scoring)
    found = uses.where("NOT seed").join(known, "value", "left_semi")
    spans = found.groupBy("k", "r").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(FOUND))
    spans = spans.withColumnsRenamed({"k": "k2", "r": "r2"})
    both = rows.join(spans, F.col("k").eqNullSafe(F.col("k2")) & F.col("r").eqNullSafe(F.col("r2")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return both.select(F.col("k").alias(key), "r", *BASE, F.coalesce(FOUND, none).alias(FOUND))


def span_texts(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of all spans, by kind as listed, then by start, comma-joined."""
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(named, kinds)), ",")


def mask(df: DataFrame, key: str = "doc_id", text: str = "text", **scoring) -> DataFrame:
    """The rows of ``df`` with every span replaced by ``[KIND]``; of overlapping spans the earlier, then longer, names it.

    All columns stay, rows without spans are unchanged.
    """
    found = find_pii(df, key, text, **scoring)
    k, r, own, at_, done_ = (free_name(n, df.columns) for n in ("_k", "_r", "_own", "_spans", "_masked"))

    def named(kind: str) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("stop"), F.lit(kind.upper()).alias("kind"))

    spans = F.sort_array(F.concat(*(
        F.transform(F.col(kind), named(kind)) for kind in (*BASE, FOUND)
    )))
    hits = found.where(" OR ".join(f"size({kind}) > 0" for kind in (*BASE, FOUND))).select(
        F.col(key).alias(k), F.col("r").alias(r), spans.alias(at_)
    ).dropDuplicates([k, r])

    def put(acc: Column, s: Column) -> Column:
        end = -s["stop"]
        gap = F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]"))))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], end).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def done(acc: Column) -> Column:
        rest = F.substring(F.col(text), acc["at"] + 1, F.length(F.col(text)))
        return F.concat(F.array_join(acc["out"], ""), rest)

    masked = F.aggregate(at_, start, put, done)
    joined = df.withColumn(own, F.xxhash64(text)).join(
        hits, F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left"
    )
    changed = joined.withColumn(done_, F.when(F.col(at_).isNotNull(), masked).otherwise(F.col(text)))
    return changed.select(*(F.col(done_).alias(text) if c == text else F.col(c) for c in df.columns))
