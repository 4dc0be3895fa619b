"""PII surrogates with DataFrame functions only.

Detected entities are replaced by keyed surrogates of the same type and format. Every word and number goes through a keyed permutation of all words of its own
shape (`scramble`): letters stay letters of their script, vowels vowels, digits digits, and case, length and punctuation stay where they are. A permutation has an
inverse, so that different entities get different surrogates by construction, whatever their number, without a table, a join or a second draw, and equal
entities get equal surrogates in every document and every run with one key (coreference). No surrogate equals its own entity.

A name's words are entities of their own: a surname is replaced alike under every title and first name; first names get an ending of their gender, taken from the title, from
the list of first names or from their own ending. In e-mail addresses local part and domain are words of their own, the top-level domain stays. Card numbers keep the validity of
their check digit, IBANs country and validity of their check digits, phone numbers the country code. IPv4 addresses are permuted as numbers.

Collision check: the distinct entities of the corpus and their surrogates are aggregated natively, and a surrogate that stands for two entities ends the run with an error.
By construction only words with letters beyond the alphabets below can cause one: they become twelve letters of a 60-bit keyed hash. A surrogate may be a word
or number that exists elsewhere in the corpus; that one is itself replaced by another, so that each surrogate in the result still stands for one entity.

Names are found behind a title, or as a listed first name before a capitalised word; a bare surname is not found. Defined results: a null text stays null, an empty
text stays empty, repeated rows get equal results, and a text without entities comes back byte for byte.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kbweave.llm.decontamination import bind

TYPES = ("name", "email", "ipv4", "ssn", "phone", "card", "iban")

#: Honorifics by grammatical gender.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Госпожа")
OPEN_TITLES = ("Dr", "Prof")

#: First names by gender; in front of a capitalised word they make a name without a title.
MALE_NAMES = "Adam Alan Albert Alexander Andrew Anthony Anton Benjamin Boris Carlos Charles Daniel David Edward Francisco Frank François George Hans Heinrich Henry Jacques James Jean John José Joseph Juan Karl Klaus Louis Luis Martin Michael Miguel Nicolas Otto Patrick Paul Pedro Peter Philip Pierre Richard Robert Stefan Stephen Thomas Walter William Wolfgang Андрей Борис Владимир Дмитрий Иван Николай Олег Павел Сергей Юрий Γιάννης Δημήτρης Κώστας Νίκος Πέτρος".split()
FEMALE_NAMES = "Alice Amelie Andrea Anna Anne Barbara Brigitte Camille Carmen Catherine Christine Claire Deborah Elena Elizabeth Emily Emma Eva Fiona Greta Hannah Helen Ingrid Irene Isabelle Jane Jennifer Jessica Julia Karin Laura Linda Lucia Margaret Maria Marie Marta Mary Monika Nadia Nina Olivia Patricia Petra Rosa Sabine Sarah Sofia Susan Ursula Галина Дарья Елена Ирина Марина Наталья Ольга Светлана Софья Юлия Ελένη Κατερίνα Μαρία Σοφία Χριστίνα".split()
#: Endings of first names by script and gender; none is the end of another.
ENDINGS = {("latin", "m"): ("in", "us", "an"), ("latin", "f"): ("ia", "na", "elle"), ("cyrillic", "m"): ("ан", "ир"), ("cyrillic", "f"): ("ия", "на"), ("greek", "m"): ("ος", "ης"), ("greek", "f"): ("ία", "να")}
#: Letters that may stand for each other.
LETTER_CLASSES = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâãäåāăąæèéêëēĕėęěìíîïĩīĭįòóôõöøōŏőœùúûüũūŭůűųýÿŷ",
    "çćĉċčďđðĝğġģĥħĵķĺļľłñńņňŕŗřśŝşšţťŧþŵźżž",
    "аеёиоуыэюяіїє",
    "бвгґджзйклмнпрстфхцчшщъь",
    "αεηιουω",
    "άέήίόύώϊϋ",
    "βγδζθκλμνξπρστφχψ",
)
ALPHABET = "".join(LETTER_CLASSES)
#: Letters without a capital of one letter; they stay.
STAY = "ßς"


def _one_of(words: list[str]) -> str:
    """A pattern of any of the words, by their first letters, so that a position is settled by a few comparisons; longer words come first."""
    tails: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        tails.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{c}(?:{'|'.join(t)})" for c, t in sorted(tails.items()))


_TITLE = _one_of([*MALE_TITLES, *FEMALE_TITLES, *OPEN_TITLES])
_GIVEN = _one_of([*MALE_NAMES, *FEMALE_NAMES])
_START = r"(?<![\p{L}\p{N}])(?=\p{Lu})"
_WORD = r"\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{L}[\p{L}\p{M}]*+)*+"
_BETWEEN = r"\x20(?:\p{Lu}\.\x20)?"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: Fixed patterns in order of precedence.
NAME = rf"{_START}(?:(?:{_TITLE})\.?\x20{_WORD}(?:{_BETWEEN}{_WORD})?|(?:{_GIVEN}){_BETWEEN}{_WORD})"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
IPV4 = rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
PHONE = r"(?<![\w.+])(?:\+[0-9]{1,3}[\x20.-]?)?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?!\w)|(?<![\w.])\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){2,5}(?!\w)|(?<![\w.-])[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"
CARD = r"(?<![\w.-])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![\w-])"
ENTITY = "|".join(f"(?:{p})" for p in (NAME, EMAIL, IPV4, SSN, PHONE, IBAN, CARD))
#: A text without any of these has no entity; the long pattern is not tried on it.
HINT = rf"[0-9@]|{_START}(?:(?:{_TITLE})\.?\x20|(?:{_GIVEN})\x20\p{{Lu}})"
#: Stands around entities while a text is taken apart; texts that hold it already take a slower way.
MARK = "\ue000"


@dataclass(frozen=True)
class Surrogates:
    key: str = "kbweave-demo-key"  # set a secret of your own
    rounds: int = 4


def digest(settings: Surrogates, *parts: Column) -> Column:
    """128 hexadecimal digits of the key and the parts."""
    return F.sha2(F.concat_ws("|", F.lit(settings.key), *parts), 512)


def drawn(hexes: Column, k: Column | int, digits: int = 4) -> Column:
    """The k-th number of `digits` hexadecimal digits, from the start again after the last."""
    many = 128 // digits
    at = F.pmod(k if isinstance(k, Column) else F.lit(k), F.lit(many)) * digits + 1
    return F.conv(F.substring(hexes, at, F.lit(digits)), 16, 10).cast("bigint")


#: For every place of ALPHABET the first place and the size of its letter class.
_FIRST = [begin for begin, letters in zip([sum(map(len, LETTER_CLASSES[:k])) for k in range(len(LETTER_CLASSES))], LETTER_CLASSES, strict=True) for _ in letters]
_SIZE = [len(letters) for letters in LETTER_CLASSES for _ in letters]


def _bounds(place: Column) -> tuple[Column, Column]:
    """(first place, size) of the letter class of a place in ALPHABET."""
    listed = lambda values: F.split(F.lit(" ".join(map(str, values))), " ").cast("array<int>")  # noqa: E731  (one literal, folded when the plan is optimized)
    return F.get(listed(_FIRST), place), F.get(listed(_SIZE), place)


def _shifted(place: Column, by: Column) -> Column:
    """Another place of the same class; places below 0 (what is not in ALPHABET) stay."""
    first, size = _bounds(place)
    return F.when(place < 0, place).otherwise((first + F.pmod(place - first + by, size.cast("bigint"))).cast("int"))


def _permuted(places: Column, tag: Column, s: Surrogates) -> Column:
    """Feistel rounds: each half is shifted by a keyed hash of the other one."""

    def rounds(half: Column) -> Column:
        state = F.struct(F.slice(places, F.lit(1), half).alias("l"), F.slice(places, half + 1, F.size(places) - half).alias("r"))
        for k in range(s.rounds):
            state = bind(state, step(k))
        return bind(state, lambda x: F.concat(x["l"], x["r"]))

    def step(k: int):
        moved, held = ("r", "l") if k % 2 else ("l", "r")

        def one(x: Column) -> Column:
            fresh = bind(digest(s, tag, F.lit(str(k)), F.array_join(x[held].cast("array<string>"), ",")), lambda h: F.transform(x[moved], lambda p, i: _shifted(p, drawn(h, i))))
            return F.struct(*[fresh.alias(n) if n == moved else x[n].alias(n) for n in ("l", "r")])

        return one

    return bind((F.size(places) / 2).cast("int"), rounds)


def scramble(word: Column, tag: Column, s: Surrogates) -> Column:
    """A keyed permutation of all words of one shape, without fixed points where a word has a letter of ALPHABET or a digit.

    The first such letter moves by 1 ... size - 1 places, by how much the others decide; the others are permuted under a key that its new value belongs to.
    """

    def spelled(chars: Column) -> Column:
        low = F.transform(chars, lambda c: F.lower(c))
        places = F.transform(low, lambda c: F.position(c, F.lit(ALPHABET)) - 1)
        foreign = F.exists(low, lambda c: (F.position(c, F.lit(ALPHABET + STAY)) == 0) & c.rlike(r"[\p{L}\p{N}]"))
        named = bind(digest(s, tag, F.array_join(low, "")), lambda h: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), F.pmod(drawn(h, k, 8), F.lit(26)).cast("int") + 1, F.lit(1))), ""))
        return F.when(foreign, named).otherwise(bind(places, lambda p: bind(F.array_position(F.transform(p, lambda x: x >= 0), True).cast("int") - 1, lambda at: F.when(at < 0, word).otherwise(letters(chars, p, at)))))

    def letters(chars: Column, places: Column, at: Column) -> Column:
        return bind(F.get(places, at), lambda head: with_head(chars, places, at, head))

    def with_head(chars: Column, places: Column, at: Column, head: Column) -> Column:
        first, size = _bounds(head)
        rest = F.transform(places, lambda p, i: F.when(i == at, -2 - first).otherwise(p))

        def joined(rest: Column) -> Column:
            by = F.pmod(drawn(digest(s, tag, F.lit("head"), F.array_join(rest.cast("array<string>"), ",")), 0, 8), size - 1) + 1
            return bind(_shifted(head, by), lambda new: bind(_permuted(rest, F.concat_ws(":", tag, new.cast("string")), s), lambda done: F.array_join(F.transform(done, lambda p, i: letter(chars, F.when(i == at, new).otherwise(p), i)), "")))

        return bind(rest, joined)

    def letter(chars: Column, place: Column, i: Column) -> Column:
        old = F.get(chars, i)
        new = F.substring(F.lit(ALPHABET), place + 1, F.lit(1))
        return F.when(place < 0, old).when((F.lower(old) != old) & (F.upper(old) == old), F.upper(new)).otherwise(new)

    return F.when(word == "", word).otherwise(bind(F.split(word, ""), spelled))


def luhn(payload: Column) -> Column:
    """Check digit that makes payload + digit valid."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(payload), ""), lambda c, i: bind(c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v))),
        F.lit(0),
        lambda s, v: s + v,
    )
    return F.pmod(-total, F.lit(10))


def iban_check(country: Column, account: Column) -> Column:
    """The check digits, as a number, that make country + digits + account valid."""
    letters = F.split(F.regexp_replace(F.lower(F.concat(account, country, F.lit("00"))), "[^0-9a-z]", ""), "")
    rest = F.aggregate(letters, F.lit(0), lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 87) % 97))
    return 98 - rest


def _script(x: Column) -> Column:
    return F.when(x.rlike(r"\p{IsCyrillic}"), "cyrillic").when(x.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


#: title, first name, what is between, last word
_PARTS = rf"^((?:(?:{_TITLE})\.?\x20)?)(?:({_WORD})({_BETWEEN}))?({_WORD})$"


def _gender(title: Column, first: Column) -> Column:
    bare = F.regexp_replace(title, r"\.?\x20$", "")
    guess = F.when(first.isin(*MALE_NAMES), "m").when(first.isin(*FEMALE_NAMES), "f").when(F.lower(first).rlike("[aeαεηыая]$"), "f").otherwise("m")
    return F.when(bare.isin(*MALE_TITLES), "m").when(bare.isin(*FEMALE_TITLES), "f").otherwise(guess)


def _pieces(e: Column, kind: Column) -> Column:
    """array<struct<text, tag>>: the words of an entity; a null tag stays as it is."""
    piece = lambda text, tag=None: F.struct(text.alias("text"), (F.lit(None).cast("string") if tag is None else tag if isinstance(tag, Column) else F.lit(tag)).alias("tag"))
    part = lambda k: F.regexp_extract(e, _PARTS, k)
    name = F.array(piece(part(1)), piece(part(2), F.concat(F.lit("given:"), _gender(part(1), part(2)))), piece(part(3), "initial"), piece(part(4), "surname"))
    domain = F.substring_index(e, "@", -1)
    host = F.regexp_extract(domain, r"^(.*)\.[^.]*$", 1)
    email = F.array(piece(F.substring_index(e, "@", 1), "email"), piece(F.lit("@")), piece(host, "domain"), piece(F.concat(F.lit("."), F.substring_index(domain, ".", -1))))
    country = F.regexp_extract(e, r"^(\+[0-9]{1,3}(?=[^0-9]))", 1)
    phone = F.array(piece(country), piece(F.substring(e, F.length(country) + 1, F.length(e)), F.concat(F.lit("phone:"), country)))
    card = F.array(piece(F.left(e, F.length(e) - 1), "card"), piece(F.right(e, F.lit(1))))
    iban = F.array(piece(F.left(e, F.lit(4))), piece(F.substring(e, F.lit(5), F.length(e)), F.concat(F.lit("iban:"), F.left(e, F.lit(2)))))
    return F.when(kind == "name", name).when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "iban", iban).otherwise(F.array(piece(e, kind)))


def _ending(given: Column, tag: Column, s: Surrogates) -> Column:
    """The ending of a first name's surrogate, by script, gender and the name itself."""
    which = F.concat(_script(given), F.substring_index(tag, ":", -1))
    number = drawn(digest(s, F.lit("ending"), tag, F.lower(given)), 0, 8)
    out = None
    for (script, gender), values in ENDINGS.items():
        value = F.get(F.array(*map(F.lit, values)), F.pmod(number, F.lit(len(values))).cast("int"))
        out = F.when(which == script + gender, value) if out is None else out.when(which == script + gender, value)
    return F.when(given == "", "").when((F.length(given) > 1) & (F.upper(given) == given), F.upper(out)).otherwise(out)


def _finish(e: Column, kind: Column, old: Column, new: Column, s: Surrogates) -> Column:
    """Join the new words, with a first name's ending and fresh check digits."""
    word = lambda k: F.get(new, F.lit(k))
    given = F.get(old, F.lit(1))
    name = F.concat(word(0), word(1), _ending(given["text"], given["tag"], s), word(2), word(3))
    digits = lambda x: F.regexp_replace(x, "[^0-9]", "")
    card = F.concat(word(0), F.pmod(luhn(digits(word(0))) + F.right(e, F.lit(1)).cast("int") - luhn(digits(F.get(old, F.lit(0))["text"])), F.lit(10)).cast("string"))
    land, account = F.left(e, F.lit(2)), F.get(old, F.lit(1))["text"]
    check = F.pmod(iban_check(land, word(1)) + F.substring(e, F.lit(3), F.lit(2)).cast("int") - iban_check(land, account), F.lit(100))
    iban = F.concat(land, F.lpad(check.cast("string"), 2, "0"), word(1))
    return F.when(kind == "name", name).when(kind == "card", card).when(kind == "iban", iban).otherwise(F.array_join(new, ""))


def _address(e: Column, s: Surrogates) -> Column:
    """An IPv4 address by a Feistel permutation of its last three octets under a first octet that always changes."""
    octet = lambda k: F.get(F.split(e, r"\."), F.lit(k)).cast("bigint")
    low = octet(2) * 256 + octet(3)
    first = F.pmod(octet(0) + F.pmod(drawn(digest(s, F.lit("ipv4"), octet(1).cast("string"), low.cast("string")), 0, 8), F.lit(255)) + 1, F.lit(256))

    def step(k: int, tag: Column):
        number = lambda held: drawn(digest(s, F.lit("ipv4"), tag, F.lit(str(k)), held.cast("string")), 0, 8)
        if k % 2:
            return lambda x: F.array(x[0], F.pmod(x[1] + number(x[0]), F.lit(65536)))
        return lambda x: F.array(F.pmod(x[0] + number(x[1]), F.lit(256)), x[1])

    def rest(new: Column) -> Column:
        state = F.array(octet(1), low)
        for k in range(s.rounds):
            state = bind(state, step(k, new.cast("string")))
        return bind(state, lambda x: F.concat_ws(".", new.cast("string"), x[0].cast("string"), F.floor(x[1] / 256).cast("string"), (x[1] % 256).cast("string")))

    return bind(first, rest)


def kind_of(e: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, pattern in (("name", NAME), ("email", EMAIL), ("ipv4", IPV4), ("ssn", SSN), ("phone", PHONE), ("iban", IBAN), ("card", CARD)):
        out = out.when(e.rlike(f"^(?:{pattern})$"), F.lit(name))
    return out.otherwise(F.lit("card"))


def surrogate(e: Column, kind: Column, s: Surrogates) -> Column:
    def words(old: Column) -> Column:
        new = F.transform(old, lambda p: F.when(p["tag"].isNull(), p["text"]).otherwise(scramble(p["text"], p["tag"], s)))
        return bind(new, lambda n: _finish(e, kind, old, n, s))

    return F.when(kind == "ipv4", _address(e, s)).otherwise(bind(_pieces(e, kind), words))


def taken_apart(text: Column) -> Column:
    """struct<gaps, found>: the entities of a text and what stands before, between and behind them; the long pattern runs over the text once."""
    parts = F.split(F.regexp_replace(text, ENTITY, f"{MARK}$0{MARK}"), MARK, -1)
    every = lambda rest: lambda ps: F.filter(ps, lambda _, i: i % 2 == rest)
    once = bind(parts, lambda ps: F.struct(every(0)(ps).alias("gaps"), every(1)(ps).alias("found")))
    twice = F.struct(F.split(text, ENTITY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)).alias("found"))
    none = F.struct(F.array(text).alias("gaps"), F.array().cast("array<string>").alias("found"))
    return F.when(~text.rlike(HINT), none).when(F.contains(text, F.lit(MARK)), twice).otherwise(once)


def entities(text: Column) -> Column:
    return taken_apart(text)["found"]


def distinct_entities(docs: DataFrame, text: str) -> DataFrame:
    """(entity, n): pre-aggregated in each task before the shuffle."""
    each = docs.where(F.col(f"`{text}`").isNotNull()).select(F.explode(entities(F.col(f"`{text}`"))).alias("entity"))
    return each.groupBy("entity").agg(F.count("*").alias("n"))


def units(found: DataFrame, s: Surrogates) -> DataFrame:
    """(tag, unit, made): what has to stay distinct, with its surrogate: the words that an entity is made of, in any case, and addresses as a whole.

    Distinct words make distinct entities, since what is left of an entity (titles, country codes, check digits, top-level domains) stays or follows from them.
    """
    e = F.col("entity")
    def words(old: Column) -> Column:
        moved = lambda p: F.struct(p["tag"].alias("tag"), F.lower(p["text"]).alias("unit"), F.lower(F.concat(scramble(p["text"], p["tag"], s), F.when(p["tag"].startswith("given:"), _ending(p["text"], p["tag"], s)).otherwise(F.lit("")))).alias("made"))
        return F.transform(F.filter(old, lambda p: p["tag"].isNotNull() & (p["text"] != "")), moved)

    def parts(kind: Column) -> Column:
        return F.when(kind == "ipv4", F.array(F.struct(F.lit("ipv4").alias("tag"), e.alias("unit"), _address(e, s).alias("made")))).otherwise(bind(_pieces(e, kind), words))

    return found.select(F.explode(bind(kind_of(e), parts)).alias("u")).select("u.*")


def collisions(found: DataFrame, s: Surrogates = Surrogates()) -> DataFrame:
    """(tag, made): surrogates that stand for two different units of the table of distinct entities; there should be none."""
    return units(found, s).groupBy("tag", "made").agg(F.min("unit").alias("a"), F.max("unit").alias("b")).where("a <> b")


def replace_pii(docs: DataFrame, text: str = "text", out: str = "pii", settings: Surrogates = Surrogates()) -> DataFrame:
    """docs with entities of `text` replaced, plus the struct `out` with the number of entities by type. The collision check runs first."""
    s = settings
    shared = collisions(distinct_entities(docs, text), s).limit(1).collect()
    if shared:
        raise RuntimeError(f"the surrogate {shared[0]['made']!r} stands for two entities: set another key")
    source = F.col(f"`{text}`")

    def fresh(parts: Column) -> Column:
        made = F.transform(parts["found"], lambda e: bind(kind_of(e), lambda k: F.struct(k.alias("kind"), surrogate(e, k, s).alias("made"))))
        return bind(made, lambda m: body(parts["gaps"], m))

    def is_kind(t: str):
        return lambda m: m["kind"] == t

    def body(gaps: Column, made: Column) -> Column:
        return F.struct(
            F.when(F.size(made) == 0, source).otherwise(F.array_join(F.zip_with(gaps, F.transform(made, lambda m: m["made"]), lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")).alias("text"),
            F.size(made).cast("long").alias("n_entities"),
            *[F.size(F.filter(made, is_kind(t))).cast("long").alias(f"n_{t}") for t in TYPES],
        )

    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != out.lower()])
    found = kept.withColumn(out, bind(taken_apart(F.coalesce(source, F.lit(""))), fresh))
    counts = F.struct(*[F.col(f"{out}.{n}") for n in ("n_entities", *[f"n_{t}" for t in TYPES])]).alias(out)
    return found.select(*[F.col(f"{out}.text").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in kept.columns], counts)
