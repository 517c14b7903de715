"""Surrogates for personal data, in DataFrame and SQL functions only.

One pattern finds entities in a text, in one pass: e-mail addresses, secrets, IBANs, IP
addresses, card numbers, social security and phone numbers, and names of persons in Latin,
Cyrillic or Greek script that follow a title or begin with a common given name. Each
different entity gets a surrogate from a keyed hash that keeps its type and format: digits
become digits, letters letters of the same case and script; card numbers and IBANs have
valid check digits. A person's name is replaced word by word, so John Smith, Mr. Smith and
Smith agree; a given name becomes one of the gender that its titles name most often, over
all spellings and documents. In a text where a name was found, its words are replaced
wherever they stand with a capital. All surrogates are checked against each other and
against the real entities, and those that collide are drawn again until none does; so
different entities stay different, and one entity has the same surrogate everywhere.
Initials and titles stay. Names without a title whose given name is not listed, and other
spellings of one IPv6 address, are not found or not linked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_text, written

#: Rounds without any gain, after which a form has too few values for its entities.
STUCK = 40
#: An entity that more than one in so many mentions name meets its surrogate by broadcast: at most so many can be.
HOT_SHARE = 10_000

#: Given names and family names by script; male and female forms stand apart.
NAMES = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Marc Noah Oscar Paul Quentin Robert Simon Thomas".split(),
    ("latin", "f"): "Anna Berta Clara Diana Elena Flora Greta Helena Ines Julia Klara Laura Maria Nora Olivia Paula Rosa Sara Tara Vera".split(),
    ("latin", "l"): "Abel Brandt Costa Dumas Ebert Fischer Garcia Hansen Iversen Jensen Keller Lopez Moreau Novak Olsen Petit Quist Roth Silva Torres".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк".split(),
    ("cyrillic", "f"): "Анна Белла Вера Галина Дарья Елена Ирина Клара Лидия Мария".split(),
    ("cyrillic", "l"): "Белых Вавилюк Гнатюк Дурново Живаго Король Лозинских Мельник Седых Черных".split(),
    ("greek", "m"): "Αλέξης Γιώργος Δημήτρης Ηλίας Θάνος Κώστας Λεωνίδας Μάριος Νίκος Πέτρος".split(),
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δανάη Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("greek", "l"): "Αλεξίου Βασιλείου Γεωργίου Δημητρίου Ηλία Θωμά Κωνσταντίνου Λαζάρου Μιχαήλ Νικολάου".split(),
}
#: Syllables and endings of made-up names, where the lists are used up.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za ze".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то ва ве во за зе".split(),
    "greek": "βα βε γα γο δα δε κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το ζα ζε".split(),
}
ENDINGS = {
    ("latin", "m"): "n r s mir no ld".split(),
    ("latin", "f"): "na ria lia nne tta sa".split(),
    ("latin", "l"): "nberg nsen rmann lez rini nski".split(),
    ("cyrillic", "m"): "н р слав мир н с".split(),
    ("cyrillic", "f"): "на рия лия нна та са".split(),
    ("cyrillic", "l"): "ненко рук ных лко ских вич".split(),
    ("greek", "m"): "νος ρης λας μος".split(),
    ("greek", "f"): "να ρία λη νία".split(),
    ("greek", "l"): "νίδου ρίου λάκη νου".split(),
}
#: Titles by the gender that they name.
MALE_TITLES = r"Mr\.?|Mister|Sir|Herr|Monsieur|Señor|Sr\.|Г-н|Господин|Κύριος"
FEMALE_TITLES = r"Mrs\.?|Ms\.?|Miss|Madam|Frau|Madame|Mademoiselle|Señora|Señorita|Sra\.|Г-жа|Госпожа|Κυρία"
OTHER_TITLES = r"Dr\.?|Prof\.?"
TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES}"
#: Common given names that a family name may follow without a title.
GIVEN_M = "Andrew Carlos Charles Christopher Daniel David Hans Heinrich James John José Joseph Juan Jürgen Karl Klaus Matthew Michael Miguel Paul Pedro Peter Pierre Richard Robert Stefan Steven Thomas Wolfgang William Александр Дмитрий Иван Сергей Γιώργος Νίκος".split()
GIVEN_F = "Anna Barbara Carmen Christine Elizabeth Emily Hannah Helen Ingrid Jane Jennifer Jessica Julia Karen Katharina Laura Linda Lucía Margaret Maria María Marie Mary Patricia Petra Sabine Sarah Sophie Susan Ursula Анна Елена Мария Ольга Ελένη Μαρία".split()
GIVEN = "|".join(sorted({*GIVEN_M, *GIVEN_F}, key=lambda n: (-len(n), n)))

NAME = r"\p{Lu}(?:\p{L}+|['’]\p{L}{2,})(?:['’-]\p{L}{2,})*"
WORD = rf"(?<!\p{{L}}){NAME}(?!\p{{L}})"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
HEX = r"[0-9A-Fa-f]{1,4}"
#: Type and pattern, first match wins. No pattern spans lines, and none has a limit that real data pass.
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,24}"),
    ("secret", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?i:password|passwd|token|secret|api_key)\b[ \t]{0,2}[=:][ \t]{0,2}\"?[A-Za-z0-9+/_-]{8,}\"?"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ip", rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"),
    ("ipv6", rf"(?<![0-9A-Za-z:.])(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{2,6}}(?::{HEX}){{1,5}})(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9-])(?:[0-9]{4}(?<s>[ -]?)[0-9]{4}\k<s>[0-9]{4}\k<s>[0-9]{4}|3[47][0-9]{2}(?<t>[ -]?)[0-9]{6}\k<t>[0-9]{5})(?![0-9-])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,4}(?![0-9])|(?<![0-9-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"),
    ("person", rf"(?<!\p{{L}})(?:{TITLES})[ ](?:\p{{Lu}}\.[ ])*{NAME}(?:[ ]{NAME}){{0,2}}(?!\p{{L}})|(?<!\p{{L}})(?:{GIVEN})[ ](?:\p{{Lu}}\.[ ])*{NAME}(?!\p{{L}})"),
]
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
_first = "".join(sorted({n[0] for n in (*GIVEN_M, *GIVEN_F, *TITLES.split("|"))}))
#: What every entity holds; texts without it are not searched. Each branch begins with few characters.
HINT = rf"[0-9@]|[=:][ \t]{{0,2}}\"?[A-Za-z+/_-]{{8}}|:[A-Fa-f]{{0,4}}:|A[KS]IA[A-Z]{{16}}|(?=[{_first}])(?<!\p{{L}})(?:{TITLES}|{GIVEN})[ ]\p{{Lu}}"
#: Set around matches; a text that holds it is cut by a slower way.
MARK = "\ue000\u0001\ue000"


def kind_of(entity: Column) -> Column:
    out = None
    for name, p in PATTERNS:
        hit = entity.rlike(f"^(?:{p})$")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def normal(entity: Column, kind: Column) -> Column:
    """What makes two spellings one entity: letter case of addresses, separators of numbers."""
    return (
        F.when(kind.isin("email", "ipv6"), F.lower(entity))
        .when(kind.isin("card", "phone", "iban", "ssn"), F.regexp_replace(entity, "[^0-9A-Za-z+]", ""))
        .otherwise(entity)
    )


def pieces(text: Column, pattern: str) -> Column:
    """The text cut around the matches: between, match, between, match, ... between."""
    quick = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    slow = F.flatten(F.transform(F.split(text, pattern, -1), lambda g, i: F.when(i < F.size(found), F.array(g, F.try_element_at(found, (i + 1).cast("int")))).otherwise(F.array(g))))
    return F.when(text.contains(MARK), slow).otherwise(quick)


def _matches(cut: Column) -> Column:
    return F.filter(cut, lambda x, i: i % 2 == 1)


def _stream(key: str, *parts: Column) -> Column:
    """256 keyed hexadecimal digits."""
    return F.concat(*(F.sha2(F.concat_ws("|", F.lit(f"{key}/{i}"), *parts), 256) for i in range(4)))


def _pick(hexes: Column, at: int, many: int) -> Column:
    return F.conv(F.substring(hexes, at, 7), 16, 10).cast("long") % many


def _masked(value: Column, hexes: Column, keep_first: Column) -> Column:
    """Character by character: digits to digits, letters to letters of the same case and script."""
    hexadecimal = value.rlike(r'(?:^|[=:" \t])[0-9a-f]{8,}"?$')
    letters = {"[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω", r"\p{L}": "abcdefghijklmnopqrstuvwxyz"}

    def one(ch: Column, i: Column) -> Column:
        r = F.conv(F.substr(hexes, (i * 2) % 250 + 1, F.lit(4)), 16, 10).cast("int")
        char_of = lambda some: F.substr(F.lit(some), r % len(some) + 1, F.lit(1))
        out = F.when(i < keep_first, ch).when(ch.rlike("^[0-9]$"), (r % 10).cast("string")).when(hexadecimal & ch.rlike("^[a-f]$"), char_of("abcdef"))
        for which, some in letters.items():
            out = out.when(ch.rlike(f"^{which}$"), char_of(some))
        return out.otherwise(ch)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The last digit replaced by the one that makes the card number valid."""
    n = F.length(digits)
    each = F.transform(F.split(F.substr(digits, F.lit(1), n - 1), ""), lambda d, i: F.when((n - i) % 2 == 0, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)).otherwise(d.cast("int")))
    total = F.aggregate(each, F.lit(0), lambda s, x: s + x)
    return F.concat(F.substr(digits, F.lit(1), n - 1), ((10 - total % 10) % 10).cast("string"))


def _iban(text: Column) -> Column:
    """The check digits replaced by the valid ones."""
    rest = F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(2)), F.lit("00"))
    value = lambda ch: F.when(ch.rlike("^[0-9]$"), ch.cast("int")).otherwise(F.ascii(ch) - 55)
    left = F.aggregate(F.split(rest, ""), F.lit(0), lambda s, ch: (s * F.when(ch.rlike("^[0-9]$"), 10).otherwise(100) + value(ch)) % 97)
    return F.concat(F.substr(text, F.lit(1), F.lit(2)), F.lpad((98 - left).cast("string"), 2, "0"), F.substr(text, F.lit(5)))


def _name(kind: Column, script: Column, h: Column, attempt: Column) -> Column:
    """A name of kind m, f (given) or l (family) in a script: from the lists first, then made of ever more syllables."""
    def pick(some: list[str], at: int | Column) -> Column:
        return F.element_at(F.array(*map(F.lit, some)), (F.conv(F.substr(h, at if isinstance(at, Column) else F.lit(at), F.lit(6)), 16, 10).cast("int") % len(some) + 1))

    out = None
    for (s, k), names in NAMES.items():
        many = F.least(1 + F.ceil(attempt / 2), F.lit(50)).cast("int")
        syllables = F.transform(F.sequence(F.lit(1), many), lambda i: pick(SYLLABLES[s], 4 * i + 9))  # noqa: B023
        made = F.concat(F.initcap(F.array_join(syllables, "")), pick(ENDINGS[s, k], 1))
        cond = (script == s) & (kind == f"word:{k}")
        one = F.when(attempt == 0, pick(names, 20)).otherwise(made)
        out = F.when(cond, one) if out is None else out.when(cond, one)
    return out


def _surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """The surrogate of an entity; each attempt gives another, of the same form."""
    h = _stream(key, kind, norm, attempt.cast("string"))
    number = F.conv(F.substring(h, 50, 12), 16, 10).cast("long") % F.pow(F.lit(10), F.least(3 + attempt, F.lit(12))).cast("long")
    email = F.concat(_masked(F.substring_index(norm, "@", 1), h, F.lit(0)), F.lit("@mail"), number.cast("string"), F.lit(".example.org"))
    ip = F.concat_ws(".", (_pick(h, 1, 223) + 1).cast("string"), *(_pick(h, 8 * i + 1, 256).cast("string") for i in (1, 2, 3)))
    ipv6 = F.array_join(F.transform(F.split(norm, ""), lambda ch, i: F.when(ch == ":", ch).otherwise(F.substr(h, i % 250 + 1, F.lit(1)))), "")
    secret_head = F.when(norm.rlike("^A[KS]IA"), F.lit(4)).otherwise(F.length(F.regexp_extract(norm, r'^[A-Za-z_]+[ \t]{0,2}[=:][ \t]{0,2}"?', 0)))
    script = F.when(norm.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(norm.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "ipv6", ipv6)
        .when(kind == "secret", _masked(norm, h, secret_head))
        .when(kind == "card", _luhn(_masked(norm, h, F.when(F.length(norm) == 15, 2).otherwise(1))))
        .when(kind == "iban", _iban(_masked(norm, h, F.lit(2))))
        .when(kind == "phone", _masked(norm, h, F.when(norm.startswith("+"), F.lit(2)).otherwise(F.lit(0))))
        .when(kind.startswith("word:"), _name(kind, script, h, attempt))
        .otherwise(_masked(norm, h, F.lit(0)))
    )


def entities(found: DataFrame) -> DataFrame:
    """space, kind, norm, times of each different entity, and of each different word of names, from rows of entity and times.

    The words of all names share one space; kind is word:m, word:f or word:l. A word is a
    given name where it mostly stands before another; its gender is the one that titles name
    most often, else that of the list, else by a hash.
    """
    one = found.groupBy("entity").agg(F.sum("times").alias("times")).withColumn("kind", kind_of(F.col("entity")))
    plain = one.where("kind <> 'person'").withColumn("norm", normal(F.col("entity"), F.col("kind")))
    plain = plain.groupBy(F.col("kind").alias("space"), "kind", "norm").agg(F.sum("times").alias("times"))
    sex = F.when(F.col("entity").rlike(rf"^(?:{MALE_TITLES}) "), "m").when(F.col("entity").rlike(rf"^(?:{FEMALE_TITLES}) "), "f")
    named = one.where("kind = 'person'").select("times", sex.alias("sex"), words_of(F.col("entity")).alias("words"))
    word = named.select("times", "sex", F.posexplode("words").alias("at", "word"), (F.size("words") - 1).alias("last"))
    given = F.col("at") < F.col("last")
    votes = lambda hit: F.sum(F.when(hit, F.col("times")).otherwise(0))
    tally = word.groupBy(F.lower("word").alias("norm")).agg(F.sum("times").alias("times"), votes(given).alias("given"), votes(given & (F.col("sex") == "m")).alias("m"), votes(given & (F.col("sex") == "f")).alias("f"))
    listed = F.when(F.col("norm").isin([n.lower() for n in GIVEN_M]), "word:m").when(F.col("norm").isin([n.lower() for n in GIVEN_F]), "word:f").when(F.crc32("norm") % 2 == 0, "word:m").otherwise("word:f")
    kind = F.when(2 * F.col("given") < F.col("times"), "word:l").when(F.col("m") > F.col("f"), "word:m").when(F.col("f") > F.col("m"), "word:f").otherwise(listed)
    return plain.unionByName(tally.select(F.lit("word").alias("space"), kind.alias("kind"), "norm", "times"))


def words_of(person: Column) -> Column:
    """The words of a name, without title and initials."""
    return F.regexp_extract_all(F.regexp_replace(person, rf"^(?:{TITLES}) ", ""), F.lit(WORD), F.lit(0))


def surrogates(found: DataFrame, key: str = "surrogate key") -> DataFrame:
    """space, norm, times, surrogate of each different entity (see entities): no two of a space alike, none equal to a real one.

    found: entity (as it stands) and times. Those that collide are drawn again, and the one
    drawn earlier stays; a form that has too few values for its entities is an error.
    """
    real = written(entities(found), "entities")
    drawn = written(real.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))), "drawn")
    least, since = None, 0
    while True:
        same = F.lower("surrogate").alias("same")
        chief = drawn.groupBy("space", same).agg(F.min_by("norm", F.struct("attempt", "norm")).alias("chief"))
        taken = real.select("space", F.lower("norm").alias("same"), F.lit(True).alias("taken")).distinct()
        judged = drawn.withColumn("same", same).join(chief, ["space", "same"]).join(taken, ["space", "same"], "left")
        again = (F.col("norm") != F.col("chief")) | F.col("taken").isNotNull()
        left = judged.where(again).count()
        if not left:
            return drawn.select("space", "norm", "times", "surrogate")
        least, since = (left, 0) if least is None or left < least else (least, since + 1)
        if since > STUCK:
            raise ValueError(f"{left} entities have too few surrogates of their form")
        attempt = F.when(again, F.col("attempt") + 1).otherwise(F.col("attempt"))
        new = F.when(again, _surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt") + 1)).otherwise(F.col("surrogate"))
        before, drawn = drawn, written(judged.select("space", "kind", "norm", "times", attempt.alias("attempt"), new.alias("surrogate")), "drawn")
        discard(before)


def _in_form(entity: Column, space: Column, surrogate: Column) -> Column:
    """The surrogate with the separators and letter case of this spelling."""
    # the i-th letter, digit or plus of the entity becomes the i-th of the surrogate
    filled = F.aggregate(
        F.split(entity, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, ch: F.when(ch.rlike("^[0-9A-Za-z+]$"), F.struct(F.concat(s["out"], F.substr(surrogate, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], ch).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )
    upper = space.isin("email", "ipv6") & (entity == F.upper(entity)) & entity.rlike(r"\p{Lu}")
    return F.when(space.isin("card", "phone", "iban", "ssn"), filled).when(upper, F.upper(surrogate)).otherwise(surrogate)


def _met(needed: DataFrame, mapping: DataFrame) -> DataFrame:
    """needed with the surrogate of its space and norm; entities that very many texts name come by broadcast."""
    total = mapping.agg(F.sum("times")).first()[0] or 0
    limit = total // HOT_SHARE + 1000
    hot = F.broadcast(mapping.where(F.col("times") > limit).drop("times"))  # at most HOT_SHARE rows
    keys = ["space", "norm"]
    rest = needed.join(hot.select(keys), keys, "left_anti").join(mapping.where(F.col("times") <= limit).drop("times"), keys)
    return needed.join(hot, keys).unionByName(rest)


def _replaced(docs: DataFrame, text_col: str, key: str) -> DataFrame:
    """docs with surrogates in text_col, and the number of entities as the last column."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = F.col(names[docs.columns.index(text_col)])
    base = docs.toDF(*names).withColumn("row", F.monotonically_increasing_id())
    cut = pieces(text.cast("string"), ENTITY)
    marked = base.withColumn("cut", F.when(text.rlike(HINT), cut))
    marked = written(marked.withColumn("cut", F.when(F.size("cut") > 1, F.col("cut"))), "marked")
    each = marked.where("cut IS NOT NULL").select("row", F.explode(F.array_distinct(_matches(F.col("cut")))).alias("entity"))
    mapping = surrogates(each.select("entity", F.lit(1).cast("long").alias("times")), key)
    kind = kind_of(F.col("entity"))
    each = each.withColumn("kind", kind)
    plain = each.where("kind <> 'person'").select("row", F.col("kind").alias("space"), normal(F.col("entity"), F.col("kind")).alias("norm"), "entity")
    words = each.where("kind = 'person'").select("row", F.explode(words_of(F.col("entity"))).alias("word"))
    words = words.select("row", F.lit("word").alias("space"), F.lower("word").alias("norm"), F.lower("word").alias("entity")).distinct()
    pairs = _met(plain.unionByName(words), mapping).select("row", "space", F.struct("entity", _in_form(F.col("entity"), F.col("space"), F.col("surrogate")).alias("to")).alias("pair"))
    maps = pairs.groupBy("row").agg(F.map_from_entries(F.collect_list("pair")).alias("map"), F.bool_or(F.col("space") == "word").alias("named"))

    def word(w: Column) -> Column:
        to = F.try_element_at("map", F.lower(w))
        return F.coalesce(F.when((w == F.upper(w)) & (F.length(w) > 1), F.upper(to)).otherwise(to), w)

    def swapped(part: Column) -> Column:
        """The words of the text's names replaced wherever they stand in a part of it."""
        return F.when(F.col("named"), F.array_join(F.transform(pieces(part, WORD), lambda w, i: F.when(i % 2 == 1, word(w)).otherwise(w)), "")).otherwise(part)

    new = F.array_join(F.transform("cut", lambda p, i: F.coalesce(F.when(i % 2 == 1, F.try_element_at("map", p)), swapped(p))), "")
    out = marked.join(maps, "row", "left").withColumn(names[docs.columns.index(text_col)], F.when(F.col("map").isNull(), text).otherwise(new))
    count = F.when(F.col("cut").isNull(), 0).otherwise(F.floor(F.size("cut") / 2)).cast("int")
    return out.select(*names, count.alias("found"))


def replace(docs: DataFrame, key: str = "surrogate key", text_col: str = "text") -> DataFrame:
    """docs, all columns, with surrogates in text_col; n_chars is set anew where docs has it.

    Null texts stay null, texts without an entity stay as they are, an empty table stays
    empty. Repeated rows each get the same text. Rows are told apart by a number of their
    own, so equal or null ids do no harm, nor do columns of any name.
    """
    out = _replaced(docs, text_col, key).drop("found").toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNull(), F.col("n_chars")).otherwise(F.length(text_col)).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def redact_documents(docs: DataFrame, key: str = "surrogate key") -> DataFrame:
    """doc_id, text with surrogates, and the number of entities found (a name's bare words later in the text not counted).

    Null texts are empty; null and repeated ids stay as they are, one row each.
    """
    return _replaced(id_text(docs), "text", key).toDF("doc_id", "text", "n_entities")
