"""Keyed surrogates for personal data, with DataFrame expressions alone.

Every entity is replaced by another of its type and format.  A surrogate is a
function of the key and the entity only, so that one entity has one surrogate in
all documents.  It is one-to-one and never the entity itself: characters move
within their own alphabets by keyed digests of the characters before them, the
first one moves on by a keyed step that is not zero, and the moves are undone by
the digests of what now stands before.  All of these are permutations, and a
permutation between a permutation and its inverse has no more fixed points than
it has itself: none.
"""

from __future__ import annotations

import hashlib
import secrets
import unicodedata
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.llm.tables import checkpointed, written

#: The session setting that holds the key; its name makes Spark redact it.
KEY_SETTING = "spark.cytoframe.pii.secret"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLES = {
    "male": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Г-н", "г-н", "господин"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mlle", "Г-жа", "г-жа", "госпожа"],
    "either": ["Dr", "Prof", "Doctor", "Professor"],
}
#: Given names by gender and script; a name moves within its own list.
GIVEN_NAMES = {
    "male latin": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter", "Hans", "Klaus", "Jean", "Pierre", "Louis", "Carlos", "Juan", "Miguel", "Pedro"],
    "female latin": ["Mary", "Anna", "Linda", "Susan", "Sarah", "Karen", "Emma", "Laura", "Julia", "Greta", "Petra", "Marie", "Claire", "Sophie", "Carmen", "Elena", "Lucia", "Rosa"],
    "male cyrillic": ["Иван", "Пётр", "Алексей", "Дмитрий", "Сергей", "Андрей", "Николай", "Михаил"],
    "female cyrillic": ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана"],
}
_TITLE = "(?:" + "|".join(t for ts in _TITLES.values() for t in ts) + ")"
_GIVEN = "(?:" + "|".join(n for ns in GIVEN_NAMES.values() for n in ns) + ")"
_WORD = r"\p{Lu}[\p{L}'’-]++"
_ASSIGNS = r"(?i:key|secret|token|password|passwd|pwd)[\"']?\s{0,3}[=:]"
#: In order of precedence at one place of a text.  All unbounded repetitions are of
#: single characters or possessive, so that the matcher's stack does not grow with a text,
#: and none is tried again from within a run that it has failed on.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9]{20,}+|xox[bap]-[A-Za-z0-9-]{10,}+)(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d)(?!\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\d)(?!\.\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    # what an assignment to a word for secrets gives, if it holds a digit before the next assignment
    "credential": rf"(?<=[=:\s\"'])(?<=[=:]\s{{0,3}}[\"']?)(?<={_ASSIGNS}\s{{0,3}}[\"']?)(?=(?:(?!{_ASSIGNS})[^\s\"'\d])*+\d)[A-Za-z0-9_\-/+=.~!@#$%^&*]{{6,}}+",
    # one or two words behind titles, or a given name and the word behind it
    "name": rf"(?<!\p{{L}})(?:(?:{_TITLE}\.? ){{1,3}}+{_WORD}(?: {_WORD})?|{_GIVEN} {_WORD})",
}


def _any(*kinds: str) -> str:
    return "(?:" + "|".join(f"(?:{PATTERNS[k]})" for k in kinds) + ")"


# The same alternatives in the same order, each group behind a test of one character or two.
ENTITY = rf"(?<![A-Za-z0-9])(?=[\w.%+-]){_any('email', 'secret', 'iban')}|(?=[0-9+(]){_any('ip', 'ssn', 'phone', 'card')}|{_any('credential')}|(?=[\p{{Lu}}г]){_any('name')}"
#: A word of a name that stands alone, as later mentions do.
_MENTION = r"(?<![\p{L}\p{N}])" + _WORD + r"(?!\p{L})"
#: A capitalised word with all that belongs to it.
_RUN = r"(?<![\p{L}\p{N}])" + _WORD
# Characters for private use mark entities; where a text holds them itself they are escaped.
_MARK, _ESCAPE, _IS_MARK, _IS_ESCAPE = "\ue000", "\ue001", "\ue002", "\ue003"


def _alphabets() -> list[str]:
    """Latin letters and digits first, then every cased letter of the basic plane by script and case."""
    first = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]
    known = set("".join(first))
    cased = [c for c in map(chr, range(0x80, 0xD800)) if c not in known and unicodedata.category(c) in ("Lu", "Ll")]
    group = lambda c: (unicodedata.name(c).split()[0], unicodedata.category(c))
    return first + [s for s in ("".join(g) for _, g in groupby(sorted(cased, key=group), key=group)) if len(s) > 1]


ALPHABETS = _alphabets()
_MOVES = "[" + "".join(ALPHABETS) + "]"
_HEX = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF"}


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _digest(*parts: Column) -> Column:
    """A number below 2**48."""
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 12), 16, 10).cast("long")


def _elements(text: Column, script: Column) -> Column:
    """The places of a text: (character, its alphabet), the alphabet empty where it stays; octets of an address are one place."""

    def own(c: Column) -> Column:
        found = F.lit("")
        for alphabet in reversed(ALPHABETS):
            found = F.when(F.position(c, F.lit(alphabet)) > 0, F.lit(alphabet)).otherwise(found)
        return found

    chars = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.struct(c.alias("c"), F.when(script == "hex", F.lit(_HEX["hex"])).when(script == "HEX", F.lit(_HEX["HEX"])).otherwise(own(c)).alias("a")))
    octets = F.transform(F.regexp_extract_all(text, F.lit(r"\d+|\."), F.lit(0)), lambda c: F.struct(c.alias("c"), F.when(c == ".", F.lit("")).otherwise(F.lit("octet")).alias("a")))
    return F.when(script == "octets", octets).otherwise(chars)


def _size(x: Column) -> Column:
    return F.when(x["a"] == "octet", 256).otherwise(F.length(x["a"]))


def _moved(x: Column, by: Column) -> Column:
    """A place's character moved in its alphabet."""
    at = F.when(x["a"] == "octet", x["c"].cast("int")).otherwise(F.position(x["c"], x["a"]) - 1)
    to = F.pmod(at + by, _size(x)).cast("int")
    return F.when(x["a"] == "", x["c"]).when(x["a"] == "octet", to.cast("string")).otherwise(F.substring(x["a"], to + 1, F.lit(1)))


def _pass(places: Column, key: Column, back: bool) -> Column:
    """Move each place by a digest of the characters before it; ``back`` undoes it."""

    def step(a: Column, x: Column) -> Column:
        by = _digest(key, a["seen"])
        return _bound(_moved(x, -by if back else by), lambda to: F.struct(F.concat(a["out"], F.array(F.struct(to.alias("c"), x["a"].alias("a")))).alias("out"), F.concat(a["seen"], to if back else x["c"]).alias("seen")))

    start = F.struct(F.array().cast("array<struct<c:string,a:string>>").alias("out"), F.lit("").alias("seen"))
    return F.aggregate(places, start, step, lambda a: a["out"])


def _stepped(places: Column, key: Column) -> Column:
    """The first place that can move, moved by a step that is not zero and depends on all others."""

    def use(p: Column) -> Column:
        at = F.array_position(F.transform(p, lambda x: x["a"] != ""), F.lit(True)) - 1
        others = F.array_join(F.transform(F.filter(p, lambda x, i: i != at), lambda x: x["c"]), "")
        return F.transform(p, lambda x, i: F.when(i == at, F.struct(_moved(x, 1 + F.pmod(_digest(key, F.lit("/step/"), others), _size(x) - 1)).alias("c"), x["a"].alias("a"))).otherwise(x))

    return _bound(places, use)


def deranged(text: Column, key: Column, script: Column) -> Column:
    """A one-to-one keyed change of ``text`` that leaves its format, and no text with a letter or digit, as it is."""
    places = _pass(_stepped(_pass(_elements(text, script), key, False), key), key, True)
    return F.array_join(F.transform(places, lambda x: x["c"]), "")


def scramble(text: Column, key: Column, script: Column | None = None) -> Column:
    """A one-to-one keyed change of texts of any length, never the text itself if it has a letter or digit.

    The first piece of 32 characters is ``deranged``; each further one moves by
    the bytes of one digest of all pieces before it.
    """
    script = F.lit("") if script is None else script

    def moved(piece: Column, key: Column) -> Column:
        return _bound(F.sha2(key, 256), lambda h: F.array_join(F.transform(_elements(piece, script), lambda x, i: _moved(x, F.conv(F.substring(h, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int"))), ""))

    def step(a: Column, piece: Column) -> Column:
        new = F.when(F.size(a["out"]) == 0, deranged(piece, a["key"], script)).otherwise(moved(piece, a["key"]))
        return F.struct(F.concat(a["out"], F.array(new)).alias("out"), F.sha2(F.concat(a["key"], F.lit("/"), piece), 256).alias("key"))

    start = F.struct(F.array().cast("array<string>").alias("out"), key.alias("key"))
    return F.aggregate(F.regexp_extract_all(text, F.lit("(?s).{1,32}"), F.lit(0)), start, step, lambda a: F.array_join(a["out"], ""))


def _check_sum(digits: Column) -> Column:
    """The sum of the check digit rule for card numbers, modulo 10."""
    doubled = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10))


def _last_digit(body: Column) -> Column:
    """The last digit of a valid card whose other digits are those of ``body``."""
    return F.pmod(10 - _check_sum(F.concat(F.regexp_replace(body, r"\D", ""), F.lit("0"))), F.lit(10)).cast("string")


def _account_check(account: Column, country: Column) -> Column:
    """The check digits, 2 to 98, that make an international account number valid."""
    plain = F.concat(F.regexp_replace(account, " ", ""), country, F.lit("00"))
    rest = F.aggregate(F.filter(F.split(plain, ""), lambda c: c != ""), F.lit(0), lambda m, c: F.pmod(F.when(c.rlike("[0-9]"), m * 10 + c.cast("int")).otherwise(m * 100 + F.ascii(c) - 55), F.lit(97)).cast("int"))
    return 98 - rest


def _names(key: str) -> dict[str, str]:
    moved = {}
    for kind, names in GIVEN_NAMES.items():
        by = 1 + int(hashlib.sha256(f"{key}/{kind}".encode()).hexdigest(), 16) % (len(names) - 1)
        moved |= {x: names[(i + by) % len(names)] for i, x in enumerate(names)}
    return moved


def kind_of(entity: Column) -> Column:
    """The kind of an entity; a lone capitalised word is a name, and a credential, told by what stands before it, all that nothing else is."""
    kind = F.lit("credential")
    tests = [*((k, p) for k, p in PATTERNS.items() if k != "credential"), ("name", _WORD)]
    for name, pattern in reversed(tests):
        kind = F.when(entity.rlike(r"\A(?:" + pattern + r")\z"), name).otherwise(kind)
    return kind


def is_entity(entity: Column, kind: Column) -> Column:
    """Digits whose check sum fails are no card number."""
    return ~((kind == "card") & F.coalesce(_check_sum(F.regexp_replace(entity, r"\D", "")) != 0, F.lit(False)))


def _lead(entity: Column, kind: Column) -> Column:
    """What stays at an entity's start."""
    lead = F.lit("")
    for name, pattern in {"secret": r"\A(?:AKIA|gh[pousr]_|sk-|xox[bap]-)?", "iban": r"\A[A-Z]{2}\d{2}", "phone": r"\A(?:\+\d{1,3}(?=[ .(-]))?", "name": rf"\A(?:{_TITLE}\.? )*+(?:{_TITLE}\z)?"}.items():
        lead = F.when(kind == name, F.regexp_extract(entity, pattern, 0)).otherwise(lead)
    return F.when((kind == "secret") & entity.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"), F.lit("")).otherwise(lead)


def _script(entity: Column, kind: Column) -> Column:
    """What an entity is written in, where that is not the alphabets."""
    hexadecimal = F.when(entity.rlike(r"\A[0-9a-f]+\z"), F.lit("hex")).when(entity.rlike(r"\A[0-9A-F]+\z"), F.lit("HEX")).otherwise(F.lit(""))
    return F.when(kind == "ip", F.lit("octets")).when(kind == "secret", hexadecimal).otherwise(F.lit(""))


def _replaced(entity: Column, kind: Column, lead: Column, script: Column, key: str) -> Column:
    """Cut into pieces (text, salt), which move but for those without a salt, put together again."""
    salt = lambda x: F.concat(F.lit(key + "/"), x)

    def piece(text: Column, salted: Column | None = None) -> Column:
        return F.struct(text.alias("s"), (F.lit(None).cast("string") if salted is None else salted).alias("salt"))

    at, ending = F.locate("@", entity), F.substring_index(entity, ".", -1)
    local, host = F.substring(entity, F.lit(1), at - 1), F.substring(entity, at + 1, F.length(entity) - at - F.length(ending))
    email = F.array(piece(local, salt(F.lit("local"))), piece(F.lit("@")), piece(host, salt(F.lit("host"))), piece(ending))
    rest = F.substring(entity, F.length(lead) + 1, F.length(entity) - F.length(lead) - F.when(kind == "card", 1).otherwise(0))
    words = F.concat(F.array(piece(lead)), F.flatten(F.transform(F.split(rest, " "), lambda w, i: F.array(piece(F.when(i > 0, F.lit(" ")).otherwise(F.lit(""))), piece(w, salt(F.lit("name")))))))
    other = F.array(piece(lead), piece(rest, salt(kind)))
    pieces = F.when(kind == "email", email).when(kind == "name", words).otherwise(other)
    given_names = _names(key)
    given = F.create_map(*[F.lit(x) for pair in given_names.items() for x in pair])
    titles = [t for ts in _TITLES.values() for t in ts]
    reserved = [*given_names, *titles]

    def move(x: Column) -> Column:
        def twice(to: Column) -> Column:  # what is no listed name and no title does not become one
            return F.when((kind == "name") & to.isin(reserved), scramble(to, x["salt"], script)).otherwise(to)

        own = F.when(kind == "name", F.element_at(given, x["s"]))
        return F.when(x["salt"].isNull() | (kind == "name") & x["s"].isin(titles), x["s"]).otherwise(F.coalesce(own, _bound(scramble(x["s"], x["salt"], script), twice)))

    def closed(new: Column) -> Column:
        country = F.substring(entity, 1, 2)
        old = F.substring(entity, 3, 2).cast("int")
        check = lambda x: _account_check(F.substring(x, F.lit(5), F.length(x)), country)
        digits = F.lpad(F.pmod(old - check(entity) + check(new), F.lit(100)).cast("string"), 2, "0")
        return F.when(kind == "card", F.concat(new, _last_digit(new))).when(kind == "iban", F.concat(country, digits, F.substring(new, F.lit(5), F.length(new)))).otherwise(new)

    return _bound(F.array_join(F.transform(pieces, move), ""), closed)


def surrogate(entity: Column, key: str) -> Column:
    """The replacement of an entity; of what is none, itself."""

    def use(x: Column) -> Column:
        entity, kind = x["entity"], x["kind"]
        return F.when(is_entity(entity, kind), _bound(F.struct(_lead(entity, kind).alias("lead"), _script(entity, kind).alias("script")), lambda y: _replaced(entity, kind, y["lead"], y["script"], key))).otherwise(entity)

    return _bound(F.struct(entity.alias("entity"), kind_of(entity).alias("kind")), use)


def _among(word: Column, words: Column) -> Column:
    """Whether a sorted array holds a word, by halving: an array or a map would be searched from its start."""

    def halve(a: Column, _: Column) -> Column:
        middle = F.shiftright(a["low"] + a["high"], 1)
        below = F.get(words, middle) < word
        return F.when(a["low"] < a["high"], F.struct(F.when(below, middle + 1).otherwise(a["low"]).alias("low"), F.when(below, a["high"]).otherwise(middle).alias("high"))).otherwise(a)

    start = F.struct(F.lit(0).alias("low"), F.size(words).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(words)))), start, halve, lambda a: F.coalesce(F.get(words, a["low"]) == word, F.lit(False)))


def _marked_words(text: Column, words: Column, longest: Column) -> Column:
    """``text`` with marks around the sorted ``words`` where they stand alone or end a word of several parts.

    ``longest`` is the length of the longest of them.  Each word of the
    text is looked up once, whatever the number of names.
    """

    def marked(run: Column) -> Column:
        # the longest ending of a run that is one of the words; endings longer than all words are not built
        def longer(a: Column, part: Column) -> Column:
            tail = F.when(F.length(a["tail"]) + F.length(part) <= longest, F.concat(part, a["tail"]))
            return _bound(tail, lambda t: F.struct(t.alias("tail"), F.when(t.isNotNull() & _among(t, words), t).otherwise(a["best"]).alias("best")))

        ends = F.reverse(F.split(run, r"(?<=['’-])(?=\p{Lu})"))
        best = F.aggregate(ends, F.struct(F.lit("").alias("tail"), F.lit("").alias("best")), longer, lambda a: a["best"])
        return _bound(best, lambda b: F.when(b == "", run).otherwise(F.concat(F.substring(run, F.lit(1), F.length(run) - F.length(b)), F.lit(_MARK), b, F.lit(_MARK))))

    pieces = F.split(F.regexp_replace(text, _RUN, f"{_MARK}$0{_MARK}"), _MARK, -1)
    return F.array_join(F.transform(pieces, lambda x, i: F.when(i % 2 == 1, marked(x)).otherwise(x)), "")


def parts_of(text: Column) -> Column:
    """A text cut at its entities: text, entity, text, ... with marks escaped; one part where there is none.

    Words of names that were found with a title or a given name are entities
    wherever else they stand alone in the same text.
    """
    safe = F.regexp_replace(F.regexp_replace(text, _ESCAPE, _ESCAPE + _IS_ESCAPE), _MARK, _ESCAPE + _IS_MARK)
    safe = F.when(text.rlike(f"[{_MARK}{_ESCAPE}]"), safe).otherwise(text)
    marked = F.regexp_replace(safe, ENTITY, f"{_MARK}$0{_MARK}")

    def mentions(parts: Column) -> Column:
        found = F.filter(parts, lambda x, i: (i % 2 == 1) & x.rlike(r"\A" + PATTERNS["name"] + r"\z"))
        words = F.filter(F.flatten(F.transform(found, lambda x: F.split(F.regexp_replace(x, rf"\A(?:{_TITLE}\.? )*+", ""), " "))), lambda w: F.length(w) > 1)
        plain = F.array_join(F.filter(parts, lambda x, i: i % 2 == 0), " ")
        return F.when(F.size(found) > 0, F.array_intersect(words, F.regexp_extract_all(plain, F.lit(_MENTION), F.lit(0)))).otherwise(F.array().cast("array<string>"))

    def again(parts: Column) -> Column:
        def use(words: Column) -> Column:
            longest = F.array_max(F.transform(words, lambda w: F.length(w)))
            new = _bound(longest, lambda most: F.transform(parts, lambda x, i: F.when(i % 2 == 0, _marked_words(x, words, most)).otherwise(x)))
            return F.when(F.size(words) > 0, F.split(F.array_join(new, _MARK), _MARK, -1)).otherwise(parts)

        return _bound(F.sort_array(mentions(parts)), use)

    return _bound(F.split(marked, _MARK, -1), again)


def cut(docs: DataFrame) -> DataFrame:
    """Numbered columns of ``docs``, text, and parts: a text with an entity is in parts alone, any other one in text alone."""
    held = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    return docs.select(*held, _bound(F.struct(F.col("text").alias("text"), parts_of(F.col("text")).alias("parts")), lambda x: F.struct(F.when(~(F.size(x["parts"]) > 1), x["text"]).alias("text"), F.when(F.size(x["parts"]) > 1, x["parts"]).alias("parts"))).alias("cut")).select(*[f"c{i}" for i, c in enumerate(docs.columns) if c != "text"], "cut.text", "cut.parts")


def entities_of(cuts: DataFrame) -> DataFrame:
    """(entity, kind): every different entity of the cut texts."""
    found = cuts.where("parts is not null").select(F.explode(F.array_distinct(F.filter("parts", lambda x, i: i % 2 == 1))).alias("entity")).distinct()
    return found.select("entity", kind_of(F.col("entity")).alias("kind")).where(is_entity(F.col("entity"), F.col("kind")))


def entities(docs: DataFrame, key: str) -> DataFrame:
    """(entity, kind, surrogate): every different entity of all whole texts."""
    return entities_of(cut(docs.select("text"))).withColumn("surrogate", surrogate(F.col("entity"), key))


def collisions(found: DataFrame) -> DataFrame:
    """Surrogates that several entities share, or that are their own entity though it has what can move."""
    movable = F.substring("entity", F.length(_lead(F.col("entity"), F.col("kind"))) + 1, F.length("entity")).rlike(_MOVES)
    shared = found.groupBy("surrogate").agg(F.count("*").alias("n"), F.max(((F.col("entity") == F.col("surrogate")) & movable).cast("int")).alias("same"))
    return shared.where("n > 1 or same = 1")


def checked_key(found: DataFrame, key: str, tries: int = 8) -> str:
    """The key, or one derived from it, under which no surrogate of these entities (entity, kind) collides or is its entity.

    Surrogates are one-to-one within a format and kind, so that the first key
    passes but for accidents between kinds, of which 48 bits of digests leave
    next to none.
    """
    for k in range(tries):
        chosen = key if not k else f"{key}#{k}"
        if not collisions(found.withColumn("surrogate", surrogate(F.col("entity"), chosen))).take(1):
            return chosen
    raise ValueError("surrogates collide under every key that was tried")


def session_key(spark: SparkSession) -> str:
    """The key that the session's configuration names; where it names none, one drawn at random for this session."""
    key = spark.conf.get(KEY_SETTING, "")
    if not key:
        key = secrets.token_hex(16)
        spark.conf.set(KEY_SETTING, key)
    return key


def anonymise(documents: DataFrame, key: str | None = None) -> DataFrame:
    """All rows and columns of ``documents``, personal data in text replaced by surrogates.

    Texts are matched once, and cut at their entities into a table of the shared
    folder; from there the different entities are checked, under further keys if
    need be, and the texts put together.  Without ``key`` the session's is used
    (``session_key``): whoever holds it can undo the surrogates, so it is no
    constant here.  Null texts stay null, empty and clean texts as they are;
    texts and entities of any length are replaced as a whole; repeated rows are
    changed alike; equal entities, ties among them, have one surrogate; an empty
    table gives none; other columns pass through, whatever their names.
    """
    cuts = written(cut(documents))
    chosen = checked_key(checkpointed(entities_of(cuts)), key or session_key(documents.sparkSession))
    new = F.array_join(F.transform("parts", lambda x, i: F.when(i % 2 == 1, surrogate(x, chosen)).otherwise(x)), "")
    new = F.when(new.contains(_ESCAPE), F.regexp_replace(F.regexp_replace(new, _ESCAPE + _IS_MARK, _MARK), _ESCAPE + _IS_ESCAPE, _ESCAPE)).otherwise(new)
    text = F.when(F.col("parts").isNotNull(), new).otherwise(F.col("text")).alias("text")
    names = documents.columns
    return cuts.select(*[text if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
