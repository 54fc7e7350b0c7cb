"""Personal data replaced by surrogates.

Entities are found by one pattern: e-mail and IPv4 addresses, card and telephone numbers, access keys, values of passwords and
tokens, and names behind a form of address. Each gets a surrogate from a keyed hash of its kind and normal form, so the same entity
has the same surrogate everywhere (coreference), also where it is written in another case or with other separators. Surrogates have the
kind, length, character classes and separators of what they replace; card numbers keep their issuer digit and stay valid if they were;
addresses keep their top-level domain; given names keep the gender that the form of address, else the list of given names, tells, and Latin,
Cyrillic and Greek names their script. A person named once is replaced wherever a capitalised word of the same document is that given or family
name, also where it is meant otherwise. An unbroken run of digits is a card number only with a valid check sum. Names, e-mail addresses and secrets may be too short for enough surrogates: from draw ``GROWS`` on, and once more after
as many draws, theirs grow by two letters, and given names by parts.

Distinctness is checked over the whole corpus: where two entities would get one surrogate, or a surrogate is itself an entity of the corpus,
all but the first (or that one) are drawn again until none is left. Only those drawn again need a join; they are few.

Texts without entities are never touched. Defined results: null and empty texts stay as they are; rows with the same ``doc_id`` are replaced
row by row; an empty table gives no rows; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, row_key, stored, table
from ledgerlens.session import task_count

#: Key of the hash. Whoever knows it can test a guess; a production run passes its own.
KEY = "surrogates"
#: Draws after which a surrogate without a length of its own grows.
GROWS = 3
#: Draws after which a kind of entity is taken to have too few surrogates: only numbers of fixed length can come to that.
MOST_DRAWS = 64

# Forms of address by gender, and given names by gender and script.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "г-жа", "госпожа"],
    "x": ["Dr", "Prof"],
}
GIVEN = {
    ("m", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leo", "Martin", "Noel", "Oscar", "Pablo"],
    ("f", "latin"): ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula"],
    ("x", "latin"): ["Alexis", "Andrea", "Chris", "Dominique", "Eli", "Jules", "Kim", "Luca", "Mika", "Noa", "Robin", "Sacha", "Sam", "Toni", "Val", "Yael"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("f", "cyrillic"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Мария"],
    ("x", "cyrillic"): ["Саша", "Женя", "Валя", "Паша", "Слава", "Шура", "Миша", "Никита"],
}

_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t)))
_NAME = r"\p{Lu}[\p{Ll}'’]+(?:-\p{Lu}[\p{Ll}'’]+)?"
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
# a number of a release is no address
_IP = r"(?<![\p{L}\d.])(?<!(?i:version|release|build|firmware) )(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
_CARD = r"(?<![\p{L}\d])\d(?:[ -]?\d){12,18}(?![\p{L}\d])"
_PHONE = r"(?<![\p{L}\d])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]\(?\d{2,4}\)?){2,5})(?!\d)"
_ACCESS = r"(?<![\p{L}\d])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\d])"
_SECRET = r"(?<![\p{L}\d])(?i:password|passwd|pwd|secret|token|api_key|apikey)[\"']? ?[=:] ?[\"']?[A-Za-z0-9_+/-]{6,256}"
_PERSON = rf"(?<![\p{{L}}\d])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?"
PATTERN = "|".join([_EMAIL, _IP, _CARD, _PHONE, _ACCESS, _SECRET, _PERSON])
#: Words that may be a later mention of a named person.
_WORD = rf"(?<![\p{{L}}\d'’]){_NAME}(?![\p{{L}}\d])"
#: Every text with an entity matches this shorter pattern too.
_ANY = rf"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|secret|token|api_?key)|(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}"


def _characters(text: Column, of) -> Column:
    """``of(place from 1, character)`` of every character, joined."""
    n = F.length(text)
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: of(i, F.substring(text, i, F.lit(1)))), "")


def _byte(stream: Column, i: Column) -> Column:
    """Number 0 to 255 for place i of the hash."""
    return F.conv(F.substring(stream, 2 * F.pmod(i, F.lit(128)) + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, b: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))


def _alike(text: Column, stream: Column, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Digits for digits, letters for letters of the same case; the rest as it is."""
    def one(i: Column, c: Column) -> Column:
        b = _byte(stream, i)
        return F.when(c.rlike("[0-9]"), _pick("0123456789", b)).when(c.rlike("[a-z]"), _pick(letters, b)).when(c.rlike("[A-Z]"), F.upper(_pick(letters, b))).otherwise(c)

    return _characters(text, one)


def _name_alike(text: Column, stream: Column) -> Column:
    """Vowels for vowels and consonants for consonants of the same script and case."""
    def one(i: Column, c: Column) -> Column:
        b, low = _byte(stream, i), F.lower(c)
        new = (
            F.when(low.rlike("[aeiouyáéíóúàèìòùâêîôûäëïöü]"), _pick("aeiou", b)).when(low.rlike(r"\p{IsLatin}"), _pick("bcdfghklmnprstvz", b))
            .when(low.rlike("[аеёиоуыэюя]"), _pick("аеиоу", b)).when(low.rlike(r"\p{IsCyrillic}"), _pick("бвгдзклмнпрст", b))
            .when(low.rlike("[αεηιουωάέήίόύώ]"), _pick("αεηιουω", b)).when(low.rlike(r"\p{IsGreek}"), _pick("βγδζθκλμνπρστ", b))
            .when(low.rlike(r"\p{L}"), _pick("bcdfghklmnprstvz", b)).otherwise(c)
        )
        return F.when(low != c, F.upper(new)).otherwise(new)

    return _characters(text, one)


def _more(draw: Column, stream: Column, first: str, second: str) -> Column:
    """Two letters for every ``GROWS`` draws; nothing at the first ones."""
    n = F.floor(draw / GROWS).cast("int")
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: F.concat(_pick(first, _byte(stream, 2 * i + 62)), _pick(second, _byte(stream, 2 * i + 63)))), "")


def _name_grown(norm: Column, draw: Column, stream: Column) -> Column:
    more = (
        F.when(norm.rlike(r"^\p{IsCyrillic}"), _more(draw, stream, "бвгдзклмнпрст", "аеиоу"))
        .when(norm.rlike(r"^\p{IsGreek}"), _more(draw, stream, "βγδζθκλμνπρστ", "αεηιουω")).otherwise(_more(draw, stream, "bcdfghklmnprstvz", "aeiou"))
    )
    return F.concat(_name_alike(norm, stream), more)


def luhn(digits: Column) -> Column:
    """Check sum of a card number; a valid one gives a multiple of ten."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _redigit(raw: Column, digits: Column) -> Column:
    """``raw`` with its digits replaced, in order, by these."""
    def one(i: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.left(raw, i))), F.lit(1))).otherwise(c)

    return _characters(raw, one)


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def kind_of(raw: Column) -> Column:
    """Kind of a match, in the order in which the pattern tries them."""
    return (
        F.when(raw.rlike("^[^ ]*@"), "email").when(raw.rlike(_whole(_IP)), "ip").when(raw.rlike(_whole(_CARD)), "card").when(raw.rlike(_whole(_PHONE)), "phone")
        .when(raw.rlike("^(?:AKIA|ASIA)[A-Z0-9]{16}$"), "access").when(raw.rlike(_whole(_SECRET)), "secret").otherwise("person")
    )


def parts_of(raw: Column, kind: Column) -> Column:
    """Pieces of a match, in order: (kind, text). Kind ``keep`` stays; names fall into given and family name."""
    def piece(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("raw"))

    before = F.regexp_extract(raw, r"^(.*[=:] ?[\"']?)", 1)
    head = F.regexp_extract(raw, r"^(\S+ )", 1)
    names = F.split(F.substring(raw, F.length(head) + 1, F.length(raw)), " ")
    title = F.regexp_replace(head, r"[. ]", "")
    known = [F.when(F.initcap(names[0]).isin([n for script in ("latin", "cyrillic") for n in GIVEN[g, script]]), g) for g in ("m", "f")]
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise(F.coalesce(*known, F.lit("x")))
    given = F.concat(F.lit("given_"), gender)
    keep, family = F.lit("keep"), F.lit("family")
    person = F.when(F.size(names) > 1, F.array(piece(keep, head), piece(given, names[0]), piece(keep, F.lit(" ")), piece(family, names[1]))).otherwise(F.array(piece(keep, head), piece(family, names[0])))
    secret = F.array(piece(keep, before), piece(kind, F.substring(raw, F.length(before) + 1, F.length(raw))))
    # an unbroken run of digits is a card number only if its check sum says so
    number = (kind == "card") & ~raw.rlike("[ -]") & (luhn(_digits(raw)) % 10 != 0)
    return F.when(number, F.array(piece(keep, raw))).when(kind == "person", person).when(kind == "secret", secret).otherwise(F.array(piece(kind, raw)))


def normal_form(kind: Column, raw: Column) -> Column:
    """What all ways to write an entity share."""
    return F.when(kind == "card", _digits(raw)).when(kind == "phone", F.right(_digits(raw), F.lit(10))).when(kind.isin("email", "family", "given_m", "given_f", "given_x"), F.lower(raw)).otherwise(raw)


def _given(norm: Column, draw: Column, stream: Column, gender: str) -> Column:
    script = F.when(norm.rlike(r"^[\p{IsLatin}'’-]+$"), "latin").when(norm.rlike(r"^[\p{IsCyrillic}'’-]+$"), "cyrillic")

    def name(pool: list[str]) -> Column:
        def one(k: int) -> Column:
            return F.get(F.array(*[F.lit(x) for x in pool]), F.pmod(_byte(stream, F.lit(k)), F.lit(len(pool))))

        return F.concat_ws("-", one(0), *[F.when(draw >= least, one(k)) for k, least in ((1, 1), (2, 3), (3, 6), (4, 12), (5, 18), (6, 24), (7, 30))])

    return F.when(script == "latin", F.lower(name(GIVEN[gender, "latin"]))).when(script == "cyrillic", F.lower(name(GIVEN[gender, "cyrillic"]))).otherwise(_name_grown(norm, draw, stream))


def with_surrogates(df: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, norm, draw`` and the surrogate ``new``. The keyed hash is a column of its own, so it is taken once and not for every character."""
    said = [F.concat_ws("|", F.lit(key), "kind", "norm", F.col("draw").cast("string"), F.lit(half)) for half in ("0", "1")]
    hashed = df.withColumn("stream", F.concat(*[F.sha2(s, 512) for s in said]))
    return hashed.withColumn("new", surrogate(F.col("kind"), F.col("norm"), F.col("draw"), F.col("stream"))).drop("stream")


def surrogate(kind: Column, norm: Column, draw: Column, stream: Column) -> Column:
    """Surrogate of a normal form, itself a normal form, at the given draw (0, 1, ...), from its keyed hash."""
    domain = F.regexp_extract(norm, r"(\.[a-z]+)$", 1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    email = F.concat(_alike(F.left(norm, F.length(norm) - F.length(domain)), stream), _more(draw, stream, letters, letters), domain)
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.pmod(_byte(stream, i), F.lit(254)) + 1).cast("string")), ".")
    body = F.concat(F.left(norm, F.lit(1)), _alike(F.substring(norm, F.lit(2), F.length(norm) - 2), stream))
    check = F.when(luhn(norm) % 10 == 0, F.pmod(F.lit(10) - luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10))).otherwise(F.pmod(_byte(stream, F.lit(127)), F.lit(10)))
    card = F.concat(body, check.cast("string"))
    phone = F.concat(_pick("23456789", _byte(stream, F.lit(0))), _alike(F.substring(norm, F.lit(2), F.lit(9)), stream))
    access = F.concat(F.left(norm, F.lit(4)), _alike(F.substring(norm, F.lit(5), F.lit(16)), stream))
    hexadecimal = F.concat(_alike(norm, stream, "abcdef"), _more(draw, stream, "abcdef", "abcdef"))
    secret = F.when(norm.rlike("^[0-9a-f]+$"), hexadecimal).otherwise(F.concat(_alike(norm, stream), _more(draw, stream, letters, letters)))
    found = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).when(kind == "access", access).when(kind == "secret", secret)
    for gender in TITLES:
        found = found.when(kind == f"given_{gender}", _given(norm, draw, stream, gender))
    return found.when(kind == "family", _name_grown(norm, draw, stream))


def render(kind: Column, raw: Column, new: Column) -> Column:
    """A surrogate written the way ``raw`` is."""
    digits = _digits(raw)
    phone = F.concat(F.left(digits, F.length(digits) - 10), new)
    cased = _characters(new, lambda i, c: F.when(F.substring(raw, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    name = F.initcap(F.regexp_replace(new, "-", "- "))
    return F.when(kind == "keep", raw).when(kind == "card", _redigit(raw, new)).when(kind == "phone", _redigit(raw, phone)).when(kind == "email", cased).when(kind.startswith("given_"), F.regexp_replace(name, "- ", "-")).when(kind == "family", cased).otherwise(new)


def redrawn(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, norm, draw`` of the entities (distinct ``kind, norm``) whose first surrogate is taken; all others keep draw 0."""
    # a number of its own: few bytes make much work here, so small partitions must not be joined
    parts = 2 * task_count(entities.sparkSession)
    entities = stored(entities.select("kind", "norm").repartition(parts, "kind", "norm"), "entities")
    state = stored(with_surrogates(entities.select("kind", "norm", F.lit(0).alias("draw")), key), "surrogates")
    for _ in range(MOST_DRAWS):
        first = state.groupBy("kind", "new").agg(F.min(F.struct("draw", "norm")).alias("m"), F.count("*").alias("n")).filter("n > 1")
        shared = state.join(first, ["kind", "new"]).filter(F.struct("draw", "norm") > F.col("m")).select("kind", "norm")
        real = state.alias("s").join(entities.alias("e"), (F.col("s.kind") == F.col("e.kind")) & (F.col("s.new") == F.col("e.norm"))).select("s.kind", "s.norm")
        taken = stored(shared.union(real).distinct(), "taken")
        if taken.isEmpty():
            return state.filter("draw > 0").select("kind", "norm", "draw")
        again = state.join(taken.withColumn("again", F.lit(1)), ["kind", "norm"], "left")
        fresh_ones = with_surrogates(again.filter("again = 1").select("kind", "norm", (F.col("draw") + 1).alias("draw")), key)
        state = stored(again.filter("again is null").select("kind", "norm", "draw", "new").unionByName(fresh_ones), "surrogates")
    raise ValueError("too few surrogates for some kind of entity")


def mentions(docs: DataFrame) -> DataFrame:
    """``row, place, part, kind, raw`` of every piece of every match."""
    text = docs.select(row_key().alias("row"), F.col("text")).filter(F.col("text").rlike(_ANY))
    found = stored(text.select("row", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found")).filter(F.size("found") > 0), "matches")
    each = found.select("row", F.posexplode("found").alias("place", "match")).withColumn("kind", kind_of(F.col("match")))
    pieces = each.select("row", "place", F.posexplode(parts_of(F.col("match"), F.col("kind"))).alias("part", "piece"))
    return pieces.select("row", "place", "part", "piece.kind", "piece.raw")


def _renamed(text: Column, names: Column, news: Column) -> Column:
    """``text`` with words that are one of ``names``, also in the possessive, replaced by the name at that place of ``news``."""
    def one(before: Column, word: Column) -> Column:
        bare = F.regexp_replace(word, "['’]s$", "")
        new = F.get(news, F.array_position(names, bare).cast("int") - 1)
        return F.concat(before, F.coalesce(F.concat(new, F.substring(word, F.length(bare) + 1, F.length(word))), word, F.lit("")))

    words = F.zip_with(F.split(text, _WORD, -1), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), one)
    return F.when(F.size(names) > 0, F.array_join(words, "")).otherwise(text)


def replace_pii(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """The documents with surrogates in ``text``; ``count`` names a further column for the number of entities replaced."""
    pieces = stored(mentions(docs).withColumn("norm", normal_form(F.col("kind"), F.col("raw"))), "mentions")
    again = redrawn(pieces.filter("kind <> 'keep'").select("kind", "norm").distinct(), key)
    drawn = pieces.join(again, ["kind", "norm"], "left").withColumn("draw", F.coalesce("draw", F.lit(0)))
    parts = 2 * task_count(docs.sparkSession)
    made = with_surrogates(drawn.repartition(parts, "row", "place", "part"), key)
    written = made.select("row", "place", "part", "kind", "raw", render(F.col("kind"), F.col("raw"), F.col("new")).alias("new"))
    listed = written.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "part", "kind", "raw", "new"))).alias("all"))
    listed = listed.withColumn("people", F.filter("all", lambda s: (s["kind"] == "family") | s["kind"].startswith("given_")))
    row, subs, names, news = (fresh(docs, c) for c in ("row", "subs", "names", "news"))
    ready = listed.select(F.col("row").alias(row), F.col("all").alias(subs), F.col("people.raw").alias(names), F.col("people.new").alias(news))
    joined = docs.withColumn(row, row_key()).join(ready, row, "left")
    between = F.split("text", PATTERN, -1)
    # behind each stretch between two matches come the pieces of the match that follows it
    rebuilt = F.array_join(
        F.transform(between, lambda x, i: F.concat(_renamed(x, F.col(names), F.col(news)), F.array_join(F.transform(F.filter(F.col(subs), lambda s: s["place"] == i), lambda s: s["new"]), ""))), "")
    text = F.when(F.col(subs).isNull(), F.col("text")).otherwise(rebuilt)
    found = joined.withColumn("text", text)
    if count:
        places = F.size(F.array_distinct(F.transform(F.filter(F.col(subs), lambda s: s["kind"] != "keep"), lambda s: s["place"])))
        found = found.withColumn(count, F.when(F.col(subs).isNull(), 0).otherwise(places))
    return found.select(*docs.columns, *([count] if count else []))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the text with surrogates and how many entities were replaced."""
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), count="n_replaced")
