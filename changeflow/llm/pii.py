"""Surrogates for personal data, in native expressions only.

Entities are found with one regular expression and named by kind and canonical form, so the same
address written in two ways is one entity. Each gets a keyed surrogate of its kind: digits for
digits, letters for letters of the same script, check digits that hold. A person is a given name
and a family name, each an entity of its own: "Ms Ada Smith", "Ada Smith" and "Ms Smith" agree in
what they share. A given name's gender is that of its title, of the list that has it, or of the
titles that it has elsewhere in the corpus. Surrogates that clash with each other or with an entity
of the corpus are drawn again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import written

# Titles by gender (n: they tell none), words that introduce a name, given names by gender and script.
TITLES = {
    "m": "Mr|Herr|Señor|Sr|Monsieur|Господин|Κύριος|السيد",
    "f": "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Госпожа|Κυρία|السيدة",
    "n": "Dr|Prof|Professor|Доктор|Профессор|Δρ|الدكتور",
}
INTRODUCED = "[Nn]ame is|[Nn]ame ist|ich heiße|Ich heiße|m'appelle|[Mm]e llamo|зовут|με λένε|اسمي"
GIVEN = {
    ("m", "latin"): "Adam Bruno David Emil Felix Hugo Jonas Karl Leo Martin Noah Oscar Paul Robert Simon Victor".split(),
    ("f", "latin"): "Alice Berta Clara Diana Emma Flora Greta Helen Irene Julia Laura Maria Nina Olivia Rosa Sarah".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Юрий".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Софья Юлия".split(),
    ("m", "greek"): "Ανδρέας Γιώργος Δημήτρης Κώστας Μάριος Νίκος Πέτρος Στέφανος".split(),
    ("f", "greek"): "Άννα Βασιλική Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("m", "arabic"): "أحمد حسن خالد سعيد عمر كريم محمد يوسف".split(),
    ("f", "arabic"): "أمينة حنان زينب سلمى عائشة فاطمة ليلى مريم".split(),
}
SYLLABLES = {
    "latin": "ban ber cor dal den fer gar hol kel lan mar nor per ros tam ver".split(),
    "cyrillic": "бан бер кор дал ден фер гар хол кел лан мар нор пер рос там вер".split(),
    "greek": "βαν βερ κορ δαλ δεν φερ γαρ χολ κελ λαν μαρ νορ περ ροσ ταμ ζερ".split(),
    "arabic": "بان بير كور دال دين فير غار هول كيل لان مار نور بير روس تام زير".split(),
}
# Sixteen letters of each script; Latin ones stand for all others.
LETTERS = {
    "Latin": "bcdfghjkmnpqrstv", "Cyrillic": "абвгдежзиклмнопр", "Greek": "βγδζθκλμνξπρτφχψ", "Arabic": "بتثجحخدرزسشصطعفق", "Hebrew": "אבגדהוזחטיכלמנסע",
    "Devanagari": "कखगघचछजझटठडढतथदध", "Han": "山川田中村林石井木水上下大小高長", "Hiragana": "あいうえかきくけさしすせたちつて", "Katakana": "アイウエカキクケサシスセタチツテ", "Hangul": "가나다라마바사아자차카타파하거너",
}

_L = r"[\p{L}0-9._%+\-]"
EMAIL = rf"(?<!{_L}){_L}++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
PHONE = r"(?<![\d+])\+\d{1,3}[ .\-]?\(?\d{2,4}\)?[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)"
CARD = r"(?<![\d.])(?:\d{4}[ \-]?){3}\d{4}(?!\d)"
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
SECRET = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])(?i:password)=[0-9A-Za-z]{6,}|(?<![A-Za-z0-9])[0-9A-Fa-f]{40}(?![A-Za-z0-9])"
_TITLE = "|".join(f"(?:{t})" for t in TITLES.values())
_NAME = r"(?:\p{Lu}[\p{L}\p{M}'\-]+|\p{IsArabic}{2,})"
#: Scripts without capitals show a family name by its article.
_FAMILY = r"(?:\p{Lu}[\p{L}\p{M}'\-]+|ال\p{IsArabic}{2,})"
_KNOWN = "|".join(sorted({n for names in GIVEN.values() for n in names}))
PERSON = rf"(?<![\p{{L}}\p{{M}}])(?=[\p{{Lu}}\p{{IsArabic}}])(?:(?:{_TITLE})\.? {_NAME}(?: {_FAMILY})?|(?:{_KNOWN}) {_FAMILY}|(?<=(?:{INTRODUCED}) ){_NAME}(?: {_FAMILY})?)"
ENTITY = "|".join((EMAIL, PHONE, CARD, IPV4, SECRET, PERSON))

_HEX = "0123456789abcdef"


def kind_of(match: Column) -> Column:
    return (
        F.when(match.contains("@"), "email")
        .when(match.startswith("+"), "phone")
        .when(match.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ip")
        .when(match.rlike(r"^(?:\d{4}[ \-]?){3}\d{4}$"), "card")
        .when(match.rlike(r"^AKIA[0-9A-Z]{16}$|^(?i:password)=|^[0-9A-Fa-f]{40}$"), "secret")
        .otherwise("person")
    )


def canonical(kind: Column, match: Column) -> Column:
    """What is the same for all ways to write an entity."""
    return F.when(kind == "email", F.lower(match)).when(kind.isin("phone", "card"), F.regexp_replace(match, "[^0-9]", "")).otherwise(match)


def parts(kind: Column, match: Column) -> Column:
    """What a place is made of: ``kind, name, piece, lead`` of each part, where ``lead`` stays and ``piece`` is replaced.

    A person's parts are of kind ``given`` (named with the gender first) and ``family``.
    """
    one = lambda k, name, piece, lead: F.struct(k.alias("kind"), name.alias("name"), piece.alias("piece"), lead.alias("lead"))
    title = F.regexp_extract(match, rf"^((?:{_TITLE})\.? )", 1)
    names = F.split(F.substring(match, F.length(title) + 1, F.length(match)), " ")
    first, second = F.get(names, F.lit(0)), F.get(names, F.lit(1))
    gender = F.lit("n")
    for g in "mf":
        gender = F.when(first.isin([n for (x, _), listed in GIVEN.items() if x == g for n in listed]), g).otherwise(gender)
    for g in "mf":
        gender = F.when(title.rlike(rf"^(?:{TITLES[g]})\.? $"), g).otherwise(gender)
    given = one(F.lit("given"), F.concat(gender, F.lit(":"), F.lower(first)), first, title)
    family = lambda name, lead: one(F.lit("family"), F.lower(name), name, lead)
    person = F.when(F.size(names) > 1, F.array(given, family(second, F.lit(" ")))).when(title == "", F.array(given)).otherwise(F.array(family(first, title)))
    return F.when(kind == "person", person).otherwise(F.array(one(kind, canonical(kind, match), match, F.lit(""))))


def with_gender(entities: DataFrame) -> DataFrame:
    """``kind, name, of`` of distinct (kind, name): given names without a gender go by the one that the name has elsewhere, if it is one."""
    given = F.col("kind") == "given"
    bare = F.substring("name", 3, 1 << 30)
    here = lambda g: F.max(F.col("name").startswith(f"{g}:")).over(same)
    same = Window.partitionBy("bare")  # at most three rows
    names = entities.where(given).withColumn("bare", bare).withColumn("m", here("m")).withColumn("f", here("f"))
    alone = F.col("name").startswith("n:") & (F.col("m") != F.col("f"))
    of = F.when(alone, F.concat(F.when(F.col("m"), "m:").otherwise("f:"), F.col("bare"))).otherwise(F.col("name"))
    return names.select("kind", "name", of.alias("of")).union(entities.where(~given).select("kind", "name", F.col("name").alias("of")))


def luhn_digit(body: Column) -> Column:
    """The check digit of a string of digits."""
    weigh = lambda d, k: F.when(k % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    digits = F.reverse(F.split(body, "(?!$)"))
    total = F.aggregate(F.transform(digits, lambda c, k: weigh(c.cast("int"), k)), F.lit(0), lambda a, d: a + d)
    return ((10 - total % 10) % 10).cast("string")


def _pick(words: list[str], octet: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (octet % len(words) + 1).cast("int"))


def surrogate(kind: Column, name: Column, attempt: Column, key: str) -> Column:
    """The canonical form of an entity's surrogate."""
    seed = F.concat_ws("|", F.lit(key), kind, name, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("+")), 256))
    digits = F.translate(stream, "abcdef", "038159")
    octet = lambda k: F.conv(F.substring(stream, 2 * k + 1, F.lit(2)), 16, 10).cast("int")

    def alike(text: Column) -> Column:
        """Digit for digit, letter for letter of the same case and script, marks as they are."""

        def one(c: Column, k: Column) -> Column:
            at = (k % 128 + 1).cast("int")
            h = F.substring(stream, at, F.lit(1))
            letter = F.translate(h, _HEX, LETTERS["Latin"])
            for script, letters in LETTERS.items():
                if script != "Latin":
                    letter = F.when(c.rlike(rf"\p{{Is{script}}}"), F.translate(h, _HEX, letters)).otherwise(letter)
            letter = F.when(c.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter)
            return F.when(c.rlike("[0-9]"), F.substring(digits, at, F.lit(1))).when(c.rlike(r"\p{L}"), letter).otherwise(c)

        return F.array_join(F.transform(F.split(text, "(?!$)"), one), "")

    # Short addresses have few alternatives: after some attempts they grow.
    more = F.when(attempt < 3, F.lit("")).when(attempt < 6, F.substring(digits, 40, 3)).otherwise(F.substring(digits, 40, 12))
    at = F.regexp_extract(name, r"^(.*)@(.*)\.([^.]*)$", 1)
    email = F.concat(alike(at), more, F.lit("@"), alike(F.regexp_extract(name, r"@(.*)\.[^.]*$", 1)), F.lit("."), F.regexp_extract(name, r"\.([^.]*)$", 1))
    n = F.length(name)
    # Numbers get more digits at the end when those of their length run short.
    longer = F.greatest(F.lit(0), F.least(attempt, F.lit(20)) - 5)
    phone = F.concat(F.substring(name, 1, 1), F.translate(F.substring(digits, 1, 1), "01", "29"), F.substring(digits, F.lit(2), n - 2 + longer))
    body = F.concat(F.substring(name, 1, 1), F.substring(digits, 1, 14))
    valid = F.substring(name, 16, 1) == luhn_digit(F.substring(name, 1, 15))
    card = F.concat(body, F.when(valid, luhn_digit(body)).otherwise(F.substring(digits, 20, 1)))
    ip = F.concat_ws(".", *((octet(F.lit(k)) % 254 + 1).cast("string") for k in range(4)))
    hexadecimal = F.when(name.rlike("[A-F]"), F.upper(F.substring(stream, 1, 40))).otherwise(F.substring(stream, 1, 40))
    fixed = F.regexp_extract(name, r"^(AKIA|(?i:password)=)", 1)
    # Passwords have no fixed length: they grow like addresses.
    alike_secret = F.concat(fixed, alike(F.substring(name, F.length(fixed) + 1, n)), F.when(fixed == "AKIA", F.lit("")).otherwise(more))
    secret = F.when(name.rlike("^[0-9A-Fa-f]{40}$"), hexadecimal).otherwise(alike_secret)
    # Each attempt has 16 times the family names of the one before, and as many times the given names as there are.
    places = F.sequence(F.lit(1), F.least(attempt, F.lit(60)) + 3)
    doubled = F.sequence(F.lit(0), F.least(attempt, F.lit(60)))
    spelled, called = F.lit(None).cast("string"), F.lit(None).cast("string")
    for script in reversed(SYLLABLES):
        mine = F.lit(True) if script == "latin" else name.rlike(rf"\p{{Is{script.capitalize()}}}")
        family = F.initcap(F.array_join(F.transform(places, lambda k: _pick(SYLLABLES[script], octet(k))), ""))  # noqa: B023
        spelled = F.coalesce(spelled, F.when(mine, family))
        lists = {"m": GIVEN["m", script], "f": GIVEN["f", script], "n": GIVEN["m", script] + GIVEN["f", script]}
        for gender, names in lists.items():
            double = F.array_join(F.transform(doubled, lambda k: _pick(names, octet(k))), "-")  # noqa: B023
            called = F.coalesce(called, F.when(mine & name.startswith(f"{gender}:"), F.concat(F.lit(f"{gender}:"), double)))
    return F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip).when(kind == "given", called).when(kind == "family", spelled).otherwise(secret)


def rendered(kind: Column, match: Column, made: Column) -> Column:
    """A surrogate in the format of the place where it goes."""

    def digit(c: Column, k: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(match, F.lit(1), (k + 1).cast("int")), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(made, before, F.lit(1))).otherwise(c)

    filled = F.concat(F.array_join(F.transform(F.split(match, "(?!$)"), digit), ""), F.substring(made, F.length(F.regexp_replace(match, "[^0-9]", "")) + 1, F.length(made)))
    loud = (match == F.upper(match)) & match.rlike(r"\p{Lu}{2}")
    return (
        F.when(kind.isin("phone", "card"), filled)
        .when(kind == "given", F.when(loud, F.upper(F.substring(made, 3, 1 << 30))).otherwise(F.substring(made, 3, 1 << 30)))
        .when(kind.isin("email", "family") & loud, F.upper(made))
        .otherwise(made)
    )


def surrogates(entities: DataFrame, key: str, *, attempts: int = 30) -> DataFrame:
    """``kind, name, made`` of distinct (kind, name) rows: distinct, and none equal to an entity of the corpus.

    Of several entities that draw one surrogate the smallest name keeps it, the others draw again.
    Emails, phones, passwords and names get longer with the attempts, so any number of them have room; cards
    (10 ** 14 of a first digit), addresses (254 ** 4) and keys keep their length.
    """
    def plain(c: str) -> Column:
        """What may not clash: names without their gender."""
        return F.when(F.col("kind") == "given", F.substring(F.lower(c), 3, 1 << 30)).when(F.col("kind") == "family", F.lower(c)).otherwise(F.col(c))

    def draw(rows: DataFrame, k: int) -> DataFrame:
        made = rows.withColumn("made", surrogate(F.col("kind"), F.col("name"), F.lit(k), key))
        return made.withColumn("as", plain("made"))

    taken = entities.select("kind", plain("name").alias("as"))
    left, done = entities, []
    for k in range(attempts):
        drawn = draw(left, k)
        winners = drawn.groupBy("kind", "as").agg(F.min("name").alias("name"), F.min_by("made", "name").alias("made")).join(taken, ["kind", "as"], "left_anti")
        winners = written(winners.select("kind", "name", "made", "as"), "pii-surrogates")
        done.append(winners.select("kind", "name", "made"))
        left = written(left.join(winners, ["kind", "name"], "left_anti"), "pii-left")
        if left.isEmpty():
            break
        taken = taken.union(winners.select("kind", "as"))
    else:
        raise ValueError(f"no distinct surrogates after {attempts} attempts")
    return reduce(DataFrame.union, done)


def pseudonymized(docs: DataFrame, *, key: str) -> DataFrame:
    """``doc_id, text, n_entities, kinds`` of every row, with all entities of the text replaced.

    ``key`` is the secret that surrogates derive from: the same key gives the same surrogates, in
    every run that has no clash. ``kinds`` lists the kinds found, sorted and comma-joined.
    Persons are names after a title, after words that introduce a name, or listed given names with
    a family name after them, in Latin, Cyrillic, Greek and Arabic letters.

    Null and empty texts come back as empty texts without entities. Repeated rows get the same
    replacements. Null doc_ids are kept. Other columns are not read. An empty table gives no rows.
    """
    return _replaced(docs, key).select(F.col("doc.doc_id").cast("long").alias("doc_id"), "text", "n_entities", "kinds")


def pseudonymized_documents(docs: DataFrame, *, key: str) -> DataFrame:
    """The rows of ``docs`` with the entities of ``text`` replaced, and ``n_chars`` set anew where there is one."""
    rows = _replaced(docs, key)
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return rows.select(*(new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns))


def _replaced(docs: DataFrame, key: str) -> DataFrame:
    """doc (the row as it was), text, n_entities, kinds."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("found", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    clean = rows.where(F.size("found") == 0).select("doc", "text", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"))
    hit = written(rows.where(F.size("found") > 0).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    places = hit.select("row", F.posexplode("found").alias("at", "match")).withColumn("sort", kind_of(F.col("match")))
    places = places.select("row", "at", "sort", F.posexplode(parts(F.col("sort"), F.col("match"))).alias("part", "p")).select("row", "at", "sort", "part", "p.*")
    entities = written(with_gender(places.select("kind", "name").distinct()), "pii-entities")
    made = surrogates(entities.select("kind", F.col("of").alias("name")).distinct(), key).withColumnRenamed("name", "of")
    made = entities.join(made, ["kind", "of"]).select("kind", "name", "made")
    made = places.join(made, ["kind", "name"]).withColumn("put", F.concat("lead", rendered(F.col("kind"), F.col("piece"), F.col("made"))))
    # One shuffle by row serves both groupings; a row holds the entities of one text.
    whole = made.repartition("row").groupBy("row", "at").agg(F.first("sort").alias("sort"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "put"))), lambda x: x["put"]), "").alias("put"))
    puts = whole.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "put"))), lambda x: x["put"]).alias("puts"), F.array_join(F.array_sort(F.collect_set("sort")), ",").alias("kinds"))
    between = F.split("text", ENTITY, -1)
    text = F.array_join(F.zip_with(between, F.concat("puts", F.array(F.lit(""))), lambda b, p: F.concat(b, p)), "")
    changed = hit.join(puts, "row").select("doc", text.alias("text"), F.size("found").cast("long").alias("n_entities"), "kinds")
    return clean.union(changed)
