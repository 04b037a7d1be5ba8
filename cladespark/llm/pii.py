"""PII: keyed surrogates of the same kind, format, script and gender, in column expressions alone.

Surrogates are permutations. A text of one shape (which characters are digits, lower and
upper case) is cut in two, and each half is shifted, character by character within its own
class, by a keyed hash of the other half, in three turns. That is one-to-one on all texts
of a shape and keeps the shape, so different entities stay different and the same entity
is always replaced alike. Addresses in dotted quads are permuted in the same way within 32
bits; card numbers keep a valid check digit valid. Names after a title get given names of the title's
gender and the name's script, and a surname made of syllables of that script. Each part of
a name is replaced by itself: the same surname always gets the same one, and different parts
of a kind get different ones, hence whole names differ too. Words of such a name are replaced
wherever else the text has them.

Collision check: over the whole corpus, no surrogate may equal another's surrogate or any
entity that occurs. Those that do move on to their next permutation, and after TURNS of them
to longer and longer ones, which can't run out, until none is left.

Defined results: null text stays null with no entities; repeated rows are replaced
alike; all other columns are kept as they are, under their own names; entities that
overlap are read from the left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch, scratch

#: A word of a name, which may be double, and up to four of them with initials.
WORD_OF_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}+(?:\p{Lu}\p{Ll}+)*(?:-\p{Lu}\p{Ll}+)*"
NAME = r"(?:\p{Lu}\. ){0,2}WORD(?: (?:\p{Lu}\. )?WORD){0,3}".replace("WORD", WORD_OF_NAME)
#: What each kind looks like (Java patterns, in the order in which they are tried).
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{3,4}[ .-]?\d{3,4}|(?:[ .-]\d{2}){4})(?!\d)|(?<![\w+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w+.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    "card": r"(?<![\w.-])[3-6]\d{12,18}(?![\w-])|(?<![\w.-])[3-6]\d{3}(?:[ -]\d{4}){3}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "key": r"(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)",
    "secret": r"(?<=(?i:password|passwd|secret|token|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?)(?:[^\s\"'=:][^\s\"']{5,}|(?=[^\s\"']{0,4}[\p{L}\p{N}])[^\s\"'=:][^\s\"']{0,4})",
    "name": r"(?<=(?<!\w)(?:Mr|Mrs|Ms)\.? |(?<!\w)(?:Miss|Herr|Frau|Monsieur|Madame|Señor|Señora|господин|госпожа) )" + NAME,
}
TITLE = r"(?<!\w)(?:(?:Mr|Mrs|Ms)\.?|Miss|Herr|Frau|Monsieur|Madame|Señor|Señora|господин|госпожа) $"
TITLED = r"(?:Mrs|Ms|Miss|Frau|Madame|Señora|госпожа)\.? $"
#: Given names by gender and script, and syllables of surnames by script.
GIVEN = {
    ("female", "latin"): ["Alice", "Clara", "Diana", "Elena", "Emma", "Helen", "Irene", "Julia", "Laura", "Maria", "Nora", "Paula", "Ruth", "Sofia", "Teresa", "Vera"],
    ("male", "latin"): ["Adam", "Bruno", "Daniel", "Eric", "Felix", "George", "Henry", "Ivan", "Jacob", "Leon", "Martin", "Oscar", "Paul", "Robert", "Simon", "Victor"],
    ("female", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("male", "cyrillic"): ["Андрей", "Борис", "Виктор", "Игорь", "Максим", "Олег", "Павел", "Юрий"],
}
SYLLABLES = {
    "latin": ["ba", "ber", "cor", "dan", "del", "fen", "gar", "hol", "kel", "lan", "lin", "mar", "mor", "nel", "nor", "per", "ram", "ros", "sel", "sten", "tal", "ter", "vin", "wel"],
    "cyrillic": ["ба", "бер", "вол", "гор", "дан", "зор", "кол", "лан", "мар", "мир", "нов", "пет", "рад", "сер", "тал", "яр"],
}
SECRET = r"(?i)(?:password|passwd|secret|token|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?$"
ANY = "|".join(PATTERNS.values())
#: A text without any of these has no entity, which plain searches see at once.
WORDS = ["@", "AKIA", "ASIA", "Mr", "Ms", "Miss ", "Herr ", "Frau ", "Monsieur ", "Madame ", "Señor", "господин ", "госпожа "]
DIGITS = "[0-9][0-9.]"
#: The keywords of secrets, in any case, with what must follow.
KEYWORDS = "(?i)(?:password|passwd|secret|token|api_?key) {0,2}[=:]"
#: Kinds of the parts of names.
NAMES = ["surname", "given female", "given male"]
#: Permutations of an entity's own shape that are tried before longer ones.
TURNS = 8
#: The letters of other scripts, each shifted within its own run.
LETTERS = ["абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "אבגדהוזחטיךכלםמןנסעףפץצקרשת", "ءآأؤإئابةتثجحخدذرزسشصضطظعغفقكلمنهوىي", "٠١٢٣٤٥٦٧٨٩"]
#: First code point and number of each larger run (kana, ideographs, Hangul).
RANGES = [(0x3041, 86), (0x30A1, 90), (0x4E00, 20976), (0xAC00, 11172)]
#: Stands on both sides of an entity while a text is cut.
MARK = "\u0001"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shifted(part: Column, stream: Column) -> Column:
    """Each digit and letter of ``part``, moved within its class by a byte (two for large scripts) of a 128-digit hex stream.

    Letters of scripts that aren't listed become ASCII letters: for them alone it isn't one-to-one.
    """

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(stream, 2 * (i % 64) + 1, 2), 16, 10).cast("int")
        within = lambda first, count: F.chr(F.lit(first) + (F.ascii(c) - first + by) % count)
        out = F.when(c.rlike("^[0-9]$"), within(48, 10)).when(c.rlike("^[a-z]$"), within(97, 26)).when(c.rlike("^[A-Z]$"), within(65, 26))
        return out.when(c.rlike(r"^[\p{L}\p{N}]$"), elsewhere(c, i, by)).otherwise(c)

    def elsewhere(c: Column, i: Column, by: Column) -> Column:
        out = F.chr(F.lit(97) + (F.ascii(c) + by) % 26)
        wide = F.conv(F.substring(stream, 2 * (i % 63) + 1, 4), 16, 10).cast("int")
        for first, count in RANGES:
            moved = F.lit(first) + (F.ascii(c) - first + wide) % count
            out = F.when(F.ascii(c).between(first, first + count - 1), F.decode(F.unhex(F.lpad(F.hex(moved), 4, "0")), "UTF-16BE")).otherwise(out)
        run = F.get(F.filter(F.array(*map(F.lit, LETTERS)), lambda x: F.contains(x, c)), F.lit(0))
        return F.coalesce(F.substring(run, (F.instr(run, c) - 1 + by) % F.char_length(run) + 1, F.lit(1)), out)

    return F.array_join(F.transform(F.split(part, ""), move), "")


def permuted(text: Column, key: Column) -> Column:
    """The keyed permutation of a text within its shape. Its three turns are a fold, so that the plan holds them once."""
    stream = lambda turn, other: F.sha2(F.concat_ws("|", key, turn.cast("string"), other).cast("binary"), 512)
    half = (F.char_length(text) / 2).cast("int")
    sides = F.struct(F.substring(text, F.lit(1), half).alias("one"), F.substring(text, half + 1, F.char_length(text)).alias("other"))
    turned = lambda s, turn: F.struct(s["other"].alias("one"), shifted(s["one"], stream(turn, s["other"])).alias("other"))
    return F.aggregate(F.array(*map(F.lit, (1, 2, 3))), sides, turned, lambda s: F.concat(s["other"], s["one"]))


def permuted_quad(text: Column, key: Column) -> Column:
    """A dotted quad, permuted within all of them."""
    octet = lambda i: F.split_part(text, F.lit("."), F.lit(i)).cast("int")
    state = F.struct((octet(1) * 256 + octet(2)).cast("long").alias("a"), (octet(3) * 256 + octet(4)).cast("long").alias("b"))
    for turn in range(4):
        state = let(state, lambda s, turn=turn: F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(F.xxhash64(key, F.lit(turn), s["b"]), F.lit(65536)), F.lit(65536)).alias("b")))
    return let(state, lambda s: F.concat_ws(".", *((x / d % 256).cast("int").cast("string") for x in (s["a"], s["b"]) for d in (256, 1))))


def luhn(digits: Column, doubled: int) -> Column:
    """The check sum of digits; the last one counts double if ``doubled`` is 0."""
    at = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == doubled, F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(at, F.lit(0), lambda a, x: a + x) % 10


def with_check_digit(digits: Column) -> Column:
    """A card number without its check digit, and the one that it gets."""
    return F.concat(digits, ((10 - luhn(F.regexp_replace(digits, "[^0-9]", ""), 0)) % 10).cast("string"))


def pick(values: list[str], seed: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(seed, F.lit(len(values))) + 1).cast("int"))


def surrogate_part(text: Column, kind: Column, key: Column, more: Column) -> Column:
    """A surname of four syllables (and ``more``), or a given name (with ``more`` syllables)."""

    def by_script(script: str) -> Column:
        syllables = lambda n: F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i > 0, pick(SYLLABLES[script], F.xxhash64(key, i, text))).otherwise("")), ""))
        given = F.when(kind == "given female", pick(GIVEN["female", script], F.xxhash64(key, text))).otherwise(pick(GIVEN["male", script], F.xxhash64(key, text)))
        return F.when(kind == "surname", syllables(4 + more)).when(more > 0, F.concat(given, F.lit("-"), syllables(more))).otherwise(given)

    return F.when(text.rlike(r"\p{IsCyrillic}"), by_script("cyrillic")).otherwise(by_script("latin"))


def parts_of(e: Column) -> Column:
    """entity, kind: what is replaced by itself. The last word of a name is the surname, both of a double one."""

    def of_name(words: Column) -> Column:
        given = F.when(e["female"], "given female").otherwise("given male")
        surnames = F.when(e["given"], F.size(words)).otherwise(F.size(words) - 1)
        each = lambda w, i: F.transform(F.split(w, "-"), lambda x: F.struct(x.alias("entity"), F.when(i < surnames, given).otherwise("surname").alias("kind")))
        return F.flatten(F.transform(words, each))

    return F.when(e["kind"] == "name", let(F.split(e["entity"], " "), of_name)).otherwise(F.array(F.struct(e["entity"].alias("entity"), e["kind"].alias("kind"))))


def kind_of(entity: Column, before: Column) -> Column:
    """The first kind that the whole of an entity looks like. What is before it tells secrets from names."""
    whole = [(k, "^(?:" + PATTERNS[k] + ")$") for k in ("email", "ip", "ssn", "phone", "card", "iban", "key")]
    out = F.when(before.rlike(SECRET), "secret").when(entity.rlike(f"^{NAME}$"), "name").otherwise("secret")
    for kind, pattern in reversed(whole):
        out = F.when(entity.rlike(pattern), kind).otherwise(out)
    return out


def surrogate(entity: Column, kind: Column, key: str, count: Column) -> Column:
    """What replaces an entity or a part of a name; ``count`` says which of its permutations, from TURNS on with more and more digits (a name: syllables).

    A text without a letter or digit to move is replaced by letters.
    """
    own = F.concat_ws("|", F.lit(key), kind, count.cast("string"))
    more = F.greatest(count - (TURNS - 1), F.lit(0))
    digits = F.array_join(F.transform(F.sequence(F.lit(0), more), lambda i: F.when(i > 0, F.pmod(F.xxhash64(own, entity, i), F.lit(10)).cast("string")).otherwise("")), "")
    kept = F.when(kind == "phone", F.regexp_extract(entity, r"^\+\d{1,3}", 0)).when(kind == "key", F.regexp_extract(entity, "^A[KS]IA", 0)).when(kind == "iban", F.regexp_extract(entity, "^[A-Z]{2}", 0)).otherwise("")
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    top = F.regexp_extract(domain, r"\.\p{L}+$", 0)
    valid = luhn(F.regexp_replace(entity, "[^0-9]", ""), 1) == 0
    part = lambda text, by: F.struct(text.alias("text"), by.alias("by"))
    from_ = lambda i, less: F.substring(entity, i, F.char_length(entity) - less)
    none = F.array().cast("array<struct<text:string,by:string>>")
    # what is permuted, each kind's parts in one array: the plan holds the permutation once
    parts = F.when(kind == "email", F.array(part(local, F.concat(own, domain)), part(F.substring(domain, F.lit(1), F.char_length(domain) - F.char_length(top)), own)))
    parts = parts.when(kind == "card", F.array(part(from_(F.lit(2), F.when(valid, 2).otherwise(0)), own)))
    parts = parts.when(kind.isin("ip", *NAMES) | ~entity.rlike(r"[\p{L}\p{N}]"), none).otherwise(F.array(part(from_(F.char_length(kept) + 1, 0), own)))
    fixed = F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.chr(F.lit(97) + F.pmod(F.xxhash64(own, entity, i), F.lit(26)))), "")

    def whole(moved: Column) -> Column:
        mail = F.concat(F.get(moved, F.lit(0)), digits, F.lit("@"), F.get(moved, F.lit(1)), top)
        card = let(F.concat(F.left(entity, F.lit(1)), F.get(moved, F.lit(0))), lambda x: F.when(valid, with_check_digit(x)).otherwise(x))
        out = F.when(kind == "ip", permuted_quad(entity, own)).when(kind == "card", card).when(F.size(moved) > 0, F.concat(kept, F.get(moved, F.lit(0)))).otherwise(fixed)
        return F.when(kind == "email", mail).when(kind.isin(NAMES), surrogate_part(entity, kind, own, more)).otherwise(F.concat(out, digits))

    return let(F.transform(parts, lambda x: permuted(x["text"], x["by"])), whole)


def pieces_of(text: Column) -> Column:
    """What is between entities and the entities in turn, the first and last between; null without entities to look for."""
    has = reduce(lambda x, y: x | y, (F.contains(text, F.lit(w)) for w in WORDS)) | text.rlike(DIGITS) | text.rlike(KEYWORDS)
    marked = F.split(F.regexp_replace(text, f"({ANY})", f"{MARK}$1{MARK}"), MARK, -1)
    between, entities = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))
    woven = F.slice(F.flatten(F.zip_with(between, entities, lambda p, e: F.array(p, F.coalesce(e, F.lit(""))))), F.lit(1), 2 * F.size(entities) + 1)
    return F.when(has, F.when(F.contains(text, F.lit(MARK)), woven).otherwise(marked))


def found_in(pieces: Column, names: Column) -> Column:
    """entity, kind, female, given: what is to be replaced, in order. A word without a title is given if the text's names have it before a surname."""
    given = lambda entity, female: F.exists(names, lambda e: (F.lit(True) if female is None else e["female"]) & F.contains(F.concat(F.lit(" "), e["entity"]), F.concat(F.lit(" "), entity, F.lit(" "))))
    places = F.filter(F.transform(pieces, lambda p, i: i), lambda i: i % 2 == 1)

    def each(i: Column) -> Column:
        entity, before = F.get(pieces, i), F.get(pieces, i - 1)
        titled = before.rlike(TITLE)
        female = F.when(titled, before.rlike(TITLED)).otherwise(given(entity, True))
        return F.struct(entity.alias("entity"), kind_of(entity, before).alias("kind"), female.alias("female"), (~titled & given(entity, None)).alias("given"))

    kind = "array<struct<entity:string,kind:string,female:boolean,given:boolean>>"
    return F.coalesce(F.transform(places, each), F.array()).cast(kind)


def mentions_in(pieces: Column, names: Column) -> Column:
    """Pieces in which words of the text's own names, wherever they are, are entities too."""
    words = F.array_distinct(F.flatten(F.transform(names, lambda e: F.filter(F.split(e["entity"], "[ -]"), lambda w: F.char_length(w) > 1))))
    words = F.filter(words, lambda w: ~F.endswith(w, F.lit(".")))
    any_ = F.concat(F.lit(r"((?<![\p{L}\p{N}_])(?:"), F.array_join(words, "|"), F.lit(r")(?![\p{L}\p{N}_]))"))

    def cut(p: Column) -> Column:
        entities = F.regexp_extract_all(p, any_, F.lit(1))
        woven = F.flatten(F.zip_with(F.split(p, any_, -1), entities, lambda x, e: F.array(x, F.coalesce(e, F.lit("")))))
        return F.slice(woven, F.lit(1), 2 * F.size(entities) + 1)

    return F.when(F.size(names) > 0, F.flatten(F.transform(pieces, lambda p, i: F.when(i % 2 == 0, cut(p)).otherwise(F.array(p))))).otherwise(pieces)


def moved_on(rows: DataFrame, key: str, tables: Scratch) -> DataFrame | None:
    """entity, kind, count: entities (of names, the parts) whose first surrogate collides, and which one doesn't; None if there are none."""
    entities = rows.select(F.explode_outer("_found").alias("e")).filter("e is not null").select(F.explode(parts_of(F.col("e"))).alias("e")).select("e.entity", "e.kind").distinct()
    entities = tables.keep(entities.withColumn("count", F.lit(0)), "entities")
    while True:  # each round has more room for those that are left
        made = tables.keep(entities.withColumn("made", surrogate(F.col("entity"), F.col("kind"), key, F.col("count"))), "made")
        one = made.groupBy("kind", "made").agg(F.min("entity").alias("first"), F.max("entity").alias("last")).filter("first <> last").select("kind", "made", "first")
        real = made.select(F.col("entity").alias("made")).distinct()
        twice = made.join(one, ["kind", "made"]).filter("entity <> first").select("kind", "entity")
        # a given name may be another's: beside a surname that is nobody's
        taken = made.filter("made <> '' and kind not like 'given%'").join(real, "made", "left_semi").select("kind", "entity")
        again = tables.keep(twice.union(taken).distinct(), "again")
        if not again.limit(1).count():
            left = entities.filter("count > 0")
            return left if left.limit(1).count() else None
        next_ = made.join(again.withColumn("more", F.lit(1)), ["kind", "entity"], "left")
        entities = tables.keep(next_.select("entity", "kind", (F.col("count") + F.coalesce("more", F.lit(0))).cast("int").alias("count")), "entities")


def replace(df: DataFrame, key: str = "surrogates", text: str = "text") -> DataFrame:
    """``df`` with surrogates in its text, and entities: array of (kind, surrogate) in order, in place of a column of that name."""
    spark = df.sparkSession
    none = F.array().cast("array<struct<entity:string,kind:string,female:boolean,given:boolean>>")
    rows = df.select(F.struct("*").alias("_given"), F.col(text).alias("_text"))  # no column of df can be taken for one of these
    rows = rows.withColumn("_first", pieces_of(F.col("_text")))
    rows = rows.withColumn("_names", F.filter(found_in(F.col("_first"), none), lambda e: e["kind"] == "name"))
    rows = rows.withColumn("_pieces", mentions_in(F.col("_first"), F.col("_names"))).withColumn("_found", found_in(F.col("_pieces"), F.col("_names")))
    with scratch(spark) as tables:
        moved = moved_on(rows, key, tables)
        moved = moved.select("entity", "kind", "count").checkpoint() if moved is not None else None
        tables.free()
    count: Callable[[Column], Column] = lambda e: F.lit(0)
    if moved is not None:  # the rows that hold one get a map of them
        row = F.xxhash64("_text")
        held = rows.select(row.alias("_row"), F.explode_outer("_found").alias("e")).filter("e is not null").select("_row", F.explode(parts_of(F.col("e"))).alias("e")).select("_row", "e.entity", "e.kind").distinct().join(moved, ["entity", "kind"])
        maps = held.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "entity"), "count"))).alias("_moved"))
        rows = rows.withColumn("_row", row).join(maps, "_row", "left")
        count = lambda e: F.coalesce(F.col("_moved")[F.concat_ws("|", e["kind"], e["entity"])], F.lit(0))
    # hyphens and spaces of names stay, and their parts are put between them
    alone = lambda e: surrogate(e["entity"], e["kind"], key, count(e))

    def whole(e: Column) -> Column:
        between = F.regexp_extract_all(e["entity"], F.lit("([ -])"), F.lit(1))
        name = lambda new: F.array_join(F.flatten(F.zip_with(new, between, lambda x, y: F.array(x, F.coalesce(y, F.lit(""))))), "")
        return let(F.transform(parts_of(e), alone), lambda new: F.when(e["kind"] == "name", name(new)).otherwise(F.get(new, F.lit(0))))

    made = F.transform("_found", lambda e: F.struct(e["kind"].alias("kind"), whole(e).alias("surrogate")))
    rows = rows.withColumn("_made", made)
    woven = F.array_join(F.transform("_pieces", lambda p, i: F.when(i % 2 == 1, F.get(F.col("_made")["surrogate"], (i / 2).cast("int"))).otherwise(p)), "")
    new = F.when(F.size("_made") > 0, woven).otherwise(F.col("_text"))
    return rows.select(*((new if c == text else F.col("_given").getField(c)).alias(c) for c in df.columns if c != "entities"), F.col("_made").alias("entities"))


