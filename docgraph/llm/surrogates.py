"""PII: detected entities are exchanged for keyed surrogates. DataFrame operations only.

One expression finds the entities; the text's other parts stay as they are. An entity's canonical form (digits of a
number, lower-cased address, each name) and a secret key give its surrogate, so every mention of an entity, in any
document and format, gets the same one (coreference). A surrogate has its entity's type and format: digits stay
digits, letters keep case, punctuation and prefixes that tell the type stay, cards keep their check-sum remainder,
IBANs their remainder mod 97, addresses stay valid, phone numbers keep their country code (a number with and without
it is one entity); names keep the gender that their title tells, if it tells one, and their script. What stands where a
password or token does is an entity whatever its form, also if it looks like a card and fails the check sum.

Collision checks preserve distinctness: the distinct entities are few against the text, and are compared with each
other. Of entities with one surrogate, or whose surrogate is itself an entity, all but one are hashed anew, round by
round, until none collide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "г-н"), "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "г-жа"), "n": ("Dr", "Prof", "Doctor", "Professor")}
ALL_TITLES = "|".join(x for k in TITLES.values() for x in k)
BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Kinds in the order in which they are tried. Secrets come first: no other kind may take a part of one.
PATTERNS = {
    "secret": r"(?<=(?i:password|passwd|secret|token|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']?)[^\s\"',;=:][^\s\"',;]{5,}",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63})+",
    "ip": rf"(?<![\d.])(?:{BYTE}\.){{3}}{BYTE}(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d+-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w.+-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "person": rf"(?<!\w)(?:{ALL_TITLES})\.? \p{{Lu}}\p{{L}}+(?:[ -]\p{{Lu}}\p{{L}}+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A cheap necessary condition, so that most texts never meet the whole expression.
HINT = rf"@|\d|(?i:password|passwd|secret|token|api_?key)|(?:{ALL_TITLES})\.? \p{{Lu}}"
SYLLABLES = {
    "latin": ["ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "xi", "yo", "zu"],
    "greek": ["βα", "γε", "δι", "ζο", "θυ", "κα", "λε", "μι", "νο", "ξυ", "πα", "ρε", "σι", "το", "φυ", "χα", "ψε", "βι", "γο", "δυ"],
    "armenian": ["բա", "գե", "դի", "զո", "թու", "կա", "լե", "մի", "նո", "շու", "պա", "ռե", "սի", "տո", "փու", "քա", "վե", "հի", "ջո", "ցու"],
    "cyrillic": ["ба", "ве", "ги", "до", "жу", "за", "ке", "ли", "мо", "ну", "па", "ре", "си", "то", "фу", "ха", "це", "чи", "шо", "лу"],
}
NAME_END = {("latin", "m"): "n", ("latin", "f"): "a", ("greek", "m"): "ς", ("greek", "f"): "α", ("armenian", "m"): "ն", ("armenian", "f"): "ա", ("latin", "n"): "r", ("greek", "n"): "ρ", ("armenian", "n"): "ր", ("cyrillic", "n"): "р", ("cyrillic", "m"): "н", ("cyrillic", "f"): "а"}
MOST_ROUNDS = 50
WIDER = 4  #: After so many rounds of collisions, and again after as many, an entity's surrogates get longer.
TEST_KEY = "a key for tests, not for use"


def kind_of(entity: Column) -> Column:
    """Of what the whole expression found. Secrets are known by what stands before them, so they are what no other
    pattern matches whole."""
    out = F.lit("secret")
    for kind, pattern in reversed(PATTERNS.items()):
        if kind != "secret":
            out = F.when(entity.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def canonical(kind: Column, entity: Column) -> Column:
    squeezed = F.regexp_replace(entity, "[^0-9A-Za-z]", "")
    national = F.substring(squeezed, F.length(dial_code(entity)) + 1, F.length(squeezed))
    return F.when(kind == "phone", national).when(kind.isin("card", "ssn", "iban"), squeezed).when(kind == "email", F.lower(entity)).otherwise(entity)


def dial_code(entity: Column) -> Column:
    """A phone number's country code: the digits up to the first sign; where there is no sign in time, 1, 7 or two digits."""
    parted = F.regexp_extract(entity, r"^\+(\d{1,3})(?=[ .(-])", 1)
    return F.when(parted != "", parted).otherwise(F.regexp_extract(entity, r"^\+([17]|\d\d)", 1))


def stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """256 hex digits."""
    block = lambda n: F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(n)), kind, attempt.cast("string"), canon), 256)
    return F.concat(*[block(n) for n in range(4)])


def pick(hexes: Column, at: Column, n: int) -> Column:
    """A number below n, from two hex digits."""
    return (F.conv(F.substring(hexes, (at % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int") % n).cast("int")


def of(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n + 1, F.lit(1))


def charwise(canon: Column, hexes: Column, before: Column, after: Column, hexadecimal: Column, lead: Column) -> Column:
    """Digits for digits and letters for letters, but for so many characters before and after. lead: no 0 or 1 comes first."""
    low, high, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def one(i: Column) -> Column:
        c = F.substring(canon, i, F.lit(1))
        return (
            F.when((i <= before) | (i > F.length(canon) - after), c)
            .when(hexadecimal & c.rlike("[0-9a-f]"), of("0123456789abcdef", pick(hexes, i, 16)))
            .when(c.rlike("[0-9]") & lead & (i == before + 1), of(digit, pick(hexes, i, 8) + 2))
            .when(c.rlike("[0-9]"), of(digit, pick(hexes, i, 10)))
            .when(c.rlike("[a-z]"), of(low, pick(hexes, i, 26)))
            .when(c.rlike(r"\p{Lu}"), of(high, pick(hexes, i, 26)))
            .when(c.rlike(r"\p{L}"), of(low, pick(hexes, i, 26)))
            .when(c.rlike(r"\p{N}"), of(digit, pick(hexes, i, 10)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(canon)), one), "")


def checked(kind: Column, entity: Column, guarded: Column) -> Column:
    """A number in the shape of a card's is one only if its check sum is right; else it is a secret where it stands as
    one (guarded), and nothing (null) elsewhere."""
    wrong = (kind == "card") & (luhn(F.regexp_replace(entity, "[^0-9]", "")) != 0)
    return F.when(~wrong, kind).when(guarded, "secret")


def mod97(text: Column) -> Column:
    """The remainder of an IBAN's characters; a letter counts as a number from 10."""

    def add(total: Column, i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        letter = F.ascii(F.upper(c)) - 55
        return F.when(c.rlike("[0-9]"), total * 10 + F.ascii(c) - 48).otherwise(total * 100 + letter) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def iban(canon: Column, bban: Column) -> Column:
    """Country, check digits and bban, with the remainder that canon has."""
    country = F.substring(canon, F.lit(1), F.lit(2))
    whole = lambda check, rest: F.concat(rest, country, check)
    was = mod97(whole(F.substring(canon, F.lit(3), F.lit(2)), F.substring(canon, F.lit(5), F.length(canon))))
    check = F.pmod(was - mod97(whole(F.lit("00"), bban)), F.lit(97))
    return F.concat(country, F.lpad(F.when(check < 2, check + 97).otherwise(check).cast("string"), 2, "0"), bban)


def luhn(digits: Column) -> Column:
    """The check sum of a card number, mod 10."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The surrogate of a canonical form, in canonical form."""
    hexes = stream(key, kind, canon, attempt)
    none, no = F.lit(0), F.lit(False)
    made = lambda before, after=none, hexadecimal=no, lead=no: charwise(canon, hexes, before, after, hexadecimal, lead)
    card = made(F.lit(1), F.lit(1))
    head = F.substring(card, F.lit(1), F.length(card) - 1)
    card = F.concat(head, F.pmod(luhn(canon) - luhn(F.concat(head, F.lit("0"))), F.lit(10)).cast("string"))
    private = canon.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.")
    octet = lambda n: F.split(canon, r"\.")[n]
    private = private & (attempt < 2 * WIDER)  # then from all of 10.*, which is private as well
    ip = F.concat_ws(".", F.when(private, octet(0)).when(canon.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\."), "10").otherwise((pick(hexes, F.lit(0), 100) + 11).cast("string")), F.when(private & octet(0).isin("172", "192"), octet(1)).otherwise(pick(hexes, F.lit(1), 256).cast("string")), pick(hexes, F.lit(2), 256).cast("string"), (pick(hexes, F.lit(3), 254) + 1).cast("string"))
    end = F.length(F.regexp_extract(canon, r"((?:[@.]example)?\.[^.@]+)$", 1))
    own = charwise(canon, hexes, none, end, no, no)
    # only addresses below reserved names stay what they are; any other domain moves there
    mail = F.when(canon.rlike(r"[@.]example\.(?:com|net|org)$|\.example$"), own).otherwise(F.concat(F.regexp_replace(own, r"\.[^.@]+$", ""), F.lit(".example")))
    extra = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: of("abcdefghijklmnopqrstuvwxyz", pick(hexes, i + 64, 26)))
    mail = F.when(attempt < WIDER, mail).otherwise(F.concat(F.array_join(extra, ""), mail))
    return (
        F.when(kind == "card", card)
        .when(kind == "ip", ip)
        .when(kind == "email", mail)
        .when(kind == "phone", made(none, lead=F.lit(True)))
        .when(kind == "iban", iban(canon, F.substring(made(F.lit(4)), F.lit(5), F.length(canon))))
        .when(kind == "access_key", made(F.lit(4)))
        .when(kind.startswith("name"), name(kind, hexes, attempt))
        .otherwise(made(none, hexadecimal=(kind == "secret") & canon.rlike("^[0-9a-f]+$")))
    )


def name(kind: Column, hexes: Column, attempt: Column) -> Column:
    """kind: name, script, gender. Four syllables, more after many collisions, the gender's ending, a capital first."""
    out = F.lit("")
    for (script, gender), end in NAME_END.items():
        syllables = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        more = [F.when(attempt >= WIDER * n, F.get(syllables, pick(hexes, F.lit(n + 3), 20))).otherwise("") for n in range(1, 4)]
        made = F.initcap(F.concat(*[F.get(syllables, pick(hexes, F.lit(n), 20)) for n in range(4)], *more, F.lit(end)))
        out = F.when(kind == f"name {script} {gender}", made).otherwise(out)
    return out


def parts_of(kind: Column, entity: Column) -> Column:
    """What of an entity is exchanged: array of (kind, canon). Of a person each name, by gender and script."""
    names = F.split(F.regexp_replace(entity, rf"^(?:{ALL_TITLES})\.? ", ""), "[ -]")
    gender = F.when(entity.rlike(rf"^(?:{'|'.join(TITLES['f'])})\.? "), "f").when(entity.rlike(rf"^(?:{'|'.join(TITLES['n'])})\.? "), "n").otherwise("m")
    script = lambda x: F.when(x.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(x.rlike(r"^\p{IsGreek}"), "greek").when(x.rlike(r"^\p{IsArmenian}"), "armenian").otherwise("latin")
    each = F.transform(names, lambda x: F.struct(F.concat_ws(" ", F.lit("name"), script(x), gender).alias("kind"), F.initcap(x).alias("canon")))
    return F.when(kind == "person", each).otherwise(F.array(F.struct(kind.alias("kind"), canonical(kind, entity).alias("canon"))))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon (distinct) -> and surrogate: no two alike, and none an entity."""
    now = cut(entities.select("kind", "canon").distinct().withColumn("attempt", F.lit(0)))
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for _ in range(MOST_ROUNDS):
        made = now.repartition(parts, "kind", "canon").withColumn("surrogate", surrogate(key, F.col("kind"), F.col("canon"), F.col("attempt")))
        taken = entities.select(F.col("canon").alias("surrogate")).distinct().withColumn("taken", F.lit(True))
        order = Window.partitionBy("surrogate").orderBy(F.col("attempt").desc(), "kind", "canon")
        made = cut(made.withColumn("nth", F.row_number().over(order)).join(taken, "surrogate", "left"))
        again = F.col("taken").isNotNull() | (F.col("nth") > 1)
        if made.where(again).isEmpty():
            return made.select("kind", "canon", "surrogate")
        now = made.select("kind", "canon", (F.col("attempt") + again.cast("int")).alias("attempt"))
    raise ValueError(f"surrogates collide after {MOST_ROUNDS} rounds")


def shaped(kind: Column, entity: Column, found: Column) -> Column:
    """Surrogates in an entity's own format: its punctuation, and capitals where it has them."""
    only = F.element_at(found, 1)
    nth = lambda i: F.length(F.regexp_replace(F.substring(entity, F.lit(1), i), "[^0-9A-Za-z]", ""))
    skip = F.when(kind == "phone", F.length(dial_code(entity))).otherwise(0)
    walk = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), lambda i: F.when(F.substring(entity, i, F.lit(1)).rlike("[0-9A-Za-z]") & (nth(i) > skip), F.substring(only, nth(i) - skip, F.lit(1))).otherwise(F.substring(entity, i, F.lit(1)))), "")
    cased = F.array_join(F.transform(F.sequence(F.lit(1), F.length(only)), lambda i: F.when(F.substring(entity, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(F.substring(only, i, F.lit(1)))).otherwise(F.substring(only, i, F.lit(1)))), "")
    title = F.regexp_extract(entity, rf"^((?:{ALL_TITLES})\.? )", 1)
    rest = F.regexp_replace(entity, rf"^(?:{ALL_TITLES})\.? ", "")
    names, gaps = F.split(rest, "[ -]"), F.concat(F.regexp_extract_all(rest, F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))
    named = F.zip_with(F.arrays_zip(names.alias("n"), gaps.alias("g")), found, lambda x, s: F.concat(F.when((F.upper(x["n"]) == x["n"]) & (F.length(x["n"]) > 1), F.upper(s)).otherwise(s), x["g"]))
    return F.when(kind.isin("phone", "card", "ssn", "iban"), walk).when(kind == "email", cased).when(kind == "person", F.concat(title, F.array_join(named, ""))).otherwise(only)


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The documents' columns with text rewritten, and n_entities and kinds (sorted, distinct); such columns are replaced.

    key is secret: who knows it can tell which surrogate an entity gets. A name that stands after a title is replaced
    wherever it stands in the same text, capital first; n_entities doesn't count such later mentions. Names in scripts
    other than those of SYLLABLES get Latin surrogates. A null text stays null and has no entities; texts without
    entities stay as they are and never shuffle. Repeated rows get equal texts. An empty table gives an empty result. A
    text is matched whole, however long it is.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("n_entities", "kinds")])
    has = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False))
    plain = docs.where(~has).withColumns({"n_entities": F.lit(0), "kinds": F.array().cast("array<string>")})
    found = docs.where(has).withColumn("__matches", F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).withColumn("__text", F.sha2("text", 256))
    secrets = F.regexp_extract_all("text", F.lit(PATTERNS["secret"]), F.lit(0))
    matched = found.select("__text", F.explode(F.array_distinct("__matches")).alias("entity"), secrets.alias("secrets"))
    matched = matched.select("__text", "entity", F.array_contains("secrets", F.col("entity")).alias("guarded")).distinct()
    hits = cut(matched.select("__text", "entity", checked(kind_of(F.col("entity")), F.col("entity"), F.col("guarded")).alias("kind")).where("kind IS NOT NULL"))
    each = hits.select("kind", "entity").distinct().withColumn("parts", parts_of(F.col("kind"), F.col("entity")))
    exploded = cut(each.select("kind", "entity", F.posexplode("parts").alias("n", "part")))
    given = assign(exploded.select("part.kind", "part.canon"), key)
    joined = exploded.join(given.select(F.struct("kind", "canon").alias("part"), "surrogate"), "part")
    of_entity = joined.groupBy("kind", "entity").agg(F.sort_array(F.collect_list(F.struct("n", "surrogate", F.col("part.canon").alias("canon")))).alias("parts"))
    names = F.when(F.col("kind") == "person", F.transform("parts", lambda x: F.struct(x["canon"].alias("name"), x["surrogate"].alias("to")))).otherwise(F.array().cast("array<struct<name:string,to:string>>"))
    of_entity = of_entity.select("kind", "entity", shaped(F.col("kind"), F.col("entity"), F.transform("parts", lambda x: x["surrogate"])).alias("surrogate"), names.alias("names"))
    lists = hits.join(of_entity, ["kind", "entity"]).groupBy("__text").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("__map"), F.array_sort(F.collect_set("kind")).alias("__kinds"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))).alias("__names"))
    rest = F.split("text", ANY, -1)
    mentions = lambda r: F.aggregate("__names", r, lambda t, x: F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), x["name"], F.lit(r"(?![\p{L}\p{N}_])")), x["to"]))
    rest = F.when(F.coalesce(F.size("__names"), F.lit(0)) > 0, F.transform(rest, mentions)).otherwise(rest)
    new = F.zip_with(F.slice("__rest", F.lit(2), F.size("__rest")), "__matches", lambda r, m: F.concat(F.coalesce(F.element_at(F.col("__map"), m), m), r))
    changed = found.join(lists, "__text", "left").withColumn("__rest", rest)
    n = F.size(F.filter("__matches", lambda m: F.coalesce(F.map_contains_key("__map", m), F.lit(False))))
    changed = changed.withColumns({"text": F.concat(F.element_at("__rest", 1), F.array_join(new, "")), "n_entities": n, "kinds": F.coalesce("__kinds", F.array().cast("array<string>"))})
    return plain.select(*docs.columns, "n_entities", "kinds").unionByName(changed.select(*docs.columns, "n_entities", "kinds"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), TEST_KEY)
