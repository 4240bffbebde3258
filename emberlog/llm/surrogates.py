"""Personal data: keyed surrogates for detected entities.

1. Entities are found by patterns: mail and IP addresses, telephone, card, social-security and account
   numbers, keys and passwords, and names that follow a title.
2. The distinct entities of the corpus, in a canonical form (a number without its separators, an address in lower
   case, one entry per name), get a surrogate from a keyed digest: digits for digits and letters
   of the same case and script for letters, card numbers with a right check digit where the original has one,
   given names with an ending of the same gender, addresses under reserved domains, private IPv6 addresses.
3. Collision checks: no two entities of a kind may share a surrogate and no surrogate may be an entity
   of the corpus. Whoever fails draws again, until nobody does.
4. Texts, cut at their entities once in step 1, are rebuilt: the surrogate is poured back into the shape of each mention (separators, country code, capitals).

So the same entity reads the same everywhere and different ones stay different. All of it is built-in
functions. Most texts have no digit, @, key or title at all; these are neither searched nor joined nor shuffled. An entity that a third of all documents
mention is one row of the table of entities; its mentions are narrow rows, whose skewed join adaptive
execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.common import pin, table

#: Rounds of drawing again; a kind whose space of surrogates is used up ends in an error, not in a leak.
ROUNDS = 40

FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Srta|Doña|Госпожа|Κυρία"
MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Господин|Κύριος"
OTHER = "Dr|Prof"
TITLE = f"(?:{FEMALE}|{MALE}|{OTHER})"

EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8}"
KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])gh[opsu]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
#: The value behind a keyword; the keyword stays.
VALUE = (
    r"(?<=[=:\s\x22'])(?=[A-Za-z0-9+/_\-]{8})(?<=[=:][\s\x22']{0,3})"
    r"(?<=(?i:password|passwd|pwd|token|secret|api[_\-]?key)\x22?\s{0,2}[=:]\s{0,2}[\x22']?)[A-Za-z0-9+/_\-]{8,}={0,2}"
)
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
#: Four numbers behind a word for a version are no address.
IP = r"(?=\d)(?<![\d.])(?<!(?i:version|release|build)[.: ]{0,2})(?<![Vv]\.?)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
#: Eight groups, or fewer around a double colon; the first has four digits, as in all public ranges, and one digit at least is no letter.
IP6 = (
    r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{4}:)(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){7}"
    r"|[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){0,5}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])"
)
CARD = r"(?<![\d.])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?!\d)"
SOCIAL = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
PHONE = (
    r"(?:(?<![\d+])\+?\d{1,3}[ .\-]?)?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
    r"|(?<![\d.\-+])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])"
    r"|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)"
)
NAME = (
    rf"(?=\p{{Lu}}\p{{L}})(?<=\s)(?:(?<=(?<!\p{{L}}){TITLE}\.?\s{{1,2}})"
    rf"|(?<=(?<!\p{{L}}){TITLE}\.?\s{{1,2}}\p{{Lu}}[\p{{L}}'\-]{{1,24}}\s))\p{{Lu}}[\p{{L}}'\-]*\p{{L}}"
)
PATTERN = "|".join((EMAIL, KEY, VALUE, ACCOUNT, IP, IP6, SOCIAL, PHONE, CARD, NAME))
#: Stands around entities in marked texts; no character of any script. Texts that hold it are cut by two searches.
MARK = "\ufdd0"
#: Characters before a match that tell its kind: the longest title or keyword with what may follow it is shorter.
CONTEXT = 40

#: Every entity has a digit, an @, the head of a key, or one of these parts of a title before it; all titles hold one.
STEMS = (
    "Mr", "Ms", "Mis", "Mad", "Frau", "Mme", "Señor", "Sr", "Doña", "Госпо", "Κυρία", "Κύριος", "Sir", "Herr", "Monsieur", "Dr", "Prof",
)
#: The rest of a key may be all letters.
HEADS = ("AKIA", "ASIA", "gho_", "ghp_", "ghs_", "ghu_")
#: A value behind a keyword may be all letters.
KEYWORDS = ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key", "apikey")

#: Kinds of which a mention's digits are replaced one by one, whatever stands between them.
NUMBERS = ("phone", "card", "social")

ALPHABETS = {
    "cyrillic": ("\\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшщэюя"),
    "greek": ("\\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
    "latin": ("\\p{L}", "abcdefghijklmnopqrstuvwxyz"),
}
#: Syllables and endings of made-up names: any, feminine, masculine, family.
SYLLABLES = {
    "cyrillic": ("ма ри ле но та ке со ви да ру бе ло ни фа го пе", "на ра лия са", "тон рик вен дор", "ов ин ский енко"),
    "greek": ("μα ρι λε νο τα κε σο βι δα ρου βε λο νι φα γο πε", "να ρα λια σα", "νος ριος τας δης", "ίδης όπουλος άκης ιάδης"),
    "latin": ("ma ri le no ta ke so vi da ru be lo ni fa go pe", "na ra lia sa", "nor ric ton ven", "son ley mann ard"),
}


def kind_of(match: Column, before: Column, after: Column, following: Column) -> Column:
    """Kind of a match, from itself, the text before and after it, and the match that follows."""
    before, after = F.substring(before, -CONTEXT, CONTEXT), F.substring(after, 1, 3)
    name = r"^\p{Lu}[\p{L}'\-]*\p{L}$"
    ends = lambda titles: before.rlike(rf"(?<!\p{{L}})(?:{titles})\.?\s{{1,2}}$")
    given = after.rlike(r"^\s$") & F.coalesce(following.rlike(name), F.lit(False))
    given = given & ends(f"{FEMALE}|{MALE}|{OTHER}")
    keyword = before.rlike(r"(?i)(?:password|passwd|pwd|token|secret|api[_\-]?key)\x22?\s{0,2}[=:]\s{0,2}[\x22']?$")
    return (
        F.when(match.contains("@"), "email").when(keyword, "secret").when(match.rlike(f"^(?:{KEY})$"), "secret")
        .when(match.rlike(r"^[\d]{1,3}(\.\d{1,3}){3}$"), "ip").when(match.rlike(r"^[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]+$"), "ip6")
        .when(match.rlike(r"^[A-Z]{2}\d{2}"), "account")
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social")
        .when(match.rlike(r"^\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}$"), "card")
        .when(match.rlike(r"^[\d+(]"), "phone")
        .when(given & ends(FEMALE), "given-f").when(given & ends(MALE), "given-m").when(given, "given")
        .otherwise("family")
    )


def canonical(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (
        F.when(kind == "phone", F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits))
        .when(kind.isin(*NUMBERS), digits)
        .when(kind == "account", F.replace(match, F.lit(" "), F.lit("")))
        .when(kind.isin("secret", "ip"), match)
        .otherwise(F.lower(match))
    )


def each_char(text: Column, change) -> Column:
    """``change(character, place from 0)`` for every character, joined."""
    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: change(F.substring(text, i + 1, F.lit(1)), i)), "")


def check_digit(body: Column) -> Column:
    """The digit that completes ``body`` to a valid card number."""
    n = F.length(body)

    def weighed(i: Column) -> Column:
        d = F.substring(body, i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - 1 - i) % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weighed), F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10)).cast("string")


def hexadecimal_like(text: Column, picked) -> Column:
    """Hexadecimal digits picked anew, all else as it is."""
    return each_char(text, lambda c, i: F.when(c.rlike("^[0-9a-f]$"), picked("0123456789abcdef", i)).otherwise(c))


def drawn(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity at its ``attempt``-th draw, in canonical form."""
    seed = lambda n: F.sha2(F.concat_ws("|", F.lit(f"{key}{n}"), kind, canon, attempt.cast("string")), 256)
    digest = F.concat(seed(0), seed(1))

    def byte(i: Column | int) -> Column:
        at = F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(64)) * 2 + 1
        return F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int")

    def picked(options: str, i: Column | int) -> Column:
        letters = F.lit(options)
        return F.substring(letters, F.pmod(byte(i), F.lit(len(options))) + 1, F.lit(1))

    def like(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("^[0-9]$"), picked("0123456789", i))
        for script, alphabet in ALPHABETS.values():
            is_one = c.rlike(f"^{script}$")
            out = out.when(is_one & c.rlike(r"^\p{Lu}$"), F.upper(picked(alphabet, i))).when(is_one, picked(alphabet, i))
        return out.otherwise(c)

    same_shape = each_char(canon, like)
    number = F.concat(picked("23456789", 0), F.substring(same_shape, F.lit(2), F.length(canon)))
    phone = F.concat(F.substring(number, 1, 3), picked("23456789", 3), F.substring(number, F.lit(5), F.length(canon)))
    body = F.concat(F.substring(canon, 1, 1), F.substring(same_shape, F.lit(2), F.length(canon) - 2))
    valid = check_digit(F.substring(canon, F.lit(1), F.length(canon) - 1)) == F.right(canon, F.lit(1))
    card = F.concat(body, F.when(valid, check_digit(body)).otherwise(F.right(same_shape, F.lit(1))))
    octets = [10 + F.pmod(byte(0), F.lit(190))] + [1 + F.pmod(byte(i), F.lit(254)) for i in (1, 2, 3)]
    local, host = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    last = F.substring_index(host, ".", -1)
    reserved = F.when(last.isin("com", "net", "org"), last).otherwise("com")
    # a drawing that collided widens the space of hosts
    wide = F.conv(F.substring(digest, F.lit(81), F.least(attempt, F.lit(5)) * 2 + 2), 16, 10)
    number_of_host = F.when(attempt > 0, wide).otherwise(F.pmod(byte(40), F.lit(100)).cast("string"))
    mail = F.concat(each_char(local, like), F.lit("@mail"), number_of_host, F.lit(".example."), reserved)
    key_body = F.concat(F.substring(canon, 1, 4), F.substring(same_shape, F.lit(5), F.length(canon)))
    hexadecimal = each_char(canon, lambda c, i: picked("0123456789abcdef", i))
    secret = (
        F.when(canon.rlike("^(?:AKIA|ASIA|gh[opsu]_)"), key_body)
        .when(canon.rlike("^[0-9a-f]+$"), hexadecimal).otherwise(same_shape)
    )
    # private addresses of the same shape; a drawing that collided gains a group behind the double colon
    groups = F.concat(F.lit("fd"), F.substring(hexadecimal_like(canon, picked), F.lit(3), F.length(canon)))
    wider = F.concat(F.lit("::"), F.substring(digest, F.lit(81), F.lit(4)), F.when(canon.endswith("::"), "").otherwise(":"))
    has_room = (attempt > 0) & (F.size(F.split(canon, ":")) < 8)
    ip6 = F.when(has_room, F.replace(groups, F.lit("::"), wider)).otherwise(groups)
    account = F.concat(F.substring(canon, 1, 2), F.substring(same_shape, F.lit(3), F.length(canon)))

    def made_up(script: str) -> Column:
        some, female, male, family = (F.array(*[F.lit(s) for s in x.split()]) for x in SYLLABLES[script])
        at = lambda options, i: F.get(options, F.pmod(byte(i), F.size(options)))
        more = F.array_join(F.transform(F.sequence(F.lit(0), attempt + 1), lambda i: at(some, i)), "")
        anyone = F.concat(female, male)
        ending = (
            F.when(kind == "given-f", at(female, 50)).when(kind == "given-m", at(male, 50))
            .when(kind == "given", at(anyone, 50)).otherwise(at(family, 50))
        )
        return F.concat(more, ending)

    names = reduce(
        lambda c, s: c.when(canon.rlike(ALPHABETS[s][0]), made_up(s)), ("greek", "latin"),
        F.when(canon.rlike(ALPHABETS["cyrillic"][0]), made_up("cyrillic")),
    ).otherwise(made_up("latin"))
    return (
        F.when(kind == "email", mail).when(kind == "phone", phone).when(kind == "card", card)
        .when(kind == "social", F.concat(F.lit("9"), F.substring(same_shape, F.lit(2), F.length(canon))))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind == "ip6", ip6).when(kind == "secret", secret).when(kind == "account", account).otherwise(names)
    )


def poured(kind: Column, match: Column, surrogate: Column) -> Column:
    """The surrogate in the shape of the mention."""
    skipped = F.length(F.regexp_replace(match, "[^0-9]", "")) - F.length(surrogate)  # digits of a country code

    def number(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), "[^0-9]", "")) - skipped
        return F.when(c.rlike("^[0-9]$") & (nth > 0), F.substring(surrogate, nth, F.lit(1))).otherwise(c)

    def grouped(c: Column, i: Column) -> Column:
        nth = F.length(F.replace(F.substring(match, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        return F.when(c == " ", c).otherwise(F.substring(surrogate, nth, F.lit(1)))

    capitals = (F.upper(match) == match) & (F.lower(match) != match)
    return (
        F.when(kind.isin(*NUMBERS), each_char(match, number)).when(kind == "account", each_char(match, grouped))
        .when(kind.isin("secret", "ip"), surrogate).when(capitals, F.upper(surrogate))
        .when(kind.startswith("given") | (kind == "family"), F.initcap(surrogate)).otherwise(surrogate)
    )


def suspected(text: Column) -> Column:
    """A cheap test that no text with an entity fails; most texts do, and are read no further."""
    titled = reduce(lambda a, b: a | b, [text.contains(s) for s in STEMS])
    keyword = text.contains("=") | text.contains(":")
    lower = F.lower(text)
    keyed = keyword & reduce(lambda a, b: a | b, [lower.contains(k) for k in KEYWORDS])
    headed = reduce(lambda a, b: a | b, [text.contains(h) for h in HEADS])
    return F.coalesce(text.contains("@") | text.rlike("[0-9]") | titled | headed | keyed, F.lit(False))


def pieces(text: Column) -> Column:
    """The text cut at its entities: what lies before, an entity, what lies between, an entity, ..., what lies behind."""
    once = F.split(F.regexp_replace(text, PATTERN, f"{MARK}$0{MARK}"), MARK, -1)
    hits = F.transform(F.regexp_extract_all(text, F.lit(f"({PATTERN})"), F.lit(1)), lambda m: F.array(m))
    twice = F.zip_with(F.transform(F.split(text, PATTERN, -1), lambda p: F.array(p)), hits, lambda p, m: F.concat(p, F.coalesce(m, F.array())))
    return F.when(text.contains(MARK), F.flatten(twice)).otherwise(once)


def mentions(cut: Column) -> Column:
    """``pieces`` of a text -> array of (kind, raw, canon) of its entities in order."""
    at = lambda i: F.get(cut, 2 * i + 1)
    named = F.transform(
        F.filter(cut, lambda _, i: i % 2 == 1),
        lambda m, i: F.struct(kind_of(m, F.get(cut, 2 * i), F.get(cut, 2 * i + 2), at(i + 1)).alias("kind"), m.alias("raw")),
    )
    return F.transform(named, lambda h: F.struct(h["kind"].alias("kind"), h["raw"].alias("raw"), canonical(h["kind"], h["raw"]).alias("canon")))


def group_of(kind: Column) -> Column:
    """Given names of any gender are one group of kinds; every other kind is a group of its own."""
    return F.regexp_replace(kind, "-[fm]$", "")


def distinct_entities(spots: DataFrame) -> DataFrame:
    """(kind, canon) of mentions -> kind, canon, one row per entity: a given name has the gender of most of its titles
    that tell one (feminine where they are even), whichever title a single mention has."""
    female, male = (F.count_if(F.col("kind") == k) for k in ("given-f", "given-m"))
    counted = spots.groupBy(group_of(F.col("kind")).alias("_group"), "canon").agg(female.alias("_f"), male.alias("_m"))
    gender = F.when(F.col("_f") + F.col("_m") == 0, "").when(F.col("_f") >= F.col("_m"), "-f").otherwise("-m")
    return counted.select(F.concat("_group", gender).alias("kind"), "canon")


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon), distinct -> kind, canon, surrogate without collisions in a group of kinds.

    Each round settles, for every surrogate, the entity that holds it already or else the least, unless the
    surrogate is itself an entity of that group; all others draw again.
    """
    # the draw is heavy for its bytes: a stated number keeps adaptive execution from merging it into one task
    spread = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = entities.repartition(spread, "kind", "canon").withColumn("attempt", F.lit(0)).withColumn("settled", F.lit(False))
    now = pin(start.withColumn("surrogate", drawn(F.col("kind"), F.col("canon"), F.col("attempt"), key)), "surrogates")
    group = group_of(F.col("kind")).alias("_group")
    real = entities.select(group, F.col("canon").alias("surrogate"), F.lit(True).alias("_real"))
    for _ in range(ROUNDS):
        now = now.select("*", group)
        first = now.groupBy("_group", "surrogate").agg(F.min(F.struct(~F.col("settled"), "canon")).alias("_first"))
        judged = now.join(first, ["_group", "surrogate"]).join(real, ["_group", "surrogate"], "left")
        fine = (F.col("_first.canon") == F.col("canon")) & F.col("_real").isNull()
        judged = pin(judged.select("kind", "canon", "attempt", "surrogate", fine.alias("settled")), "judged")
        if not judged.where(~F.col("settled")).limit(1).count():
            return judged.select("kind", "canon", "surrogate")
        again = F.when(F.col("settled"), F.col("attempt")).otherwise(F.col("attempt") + 1)
        redrawn = judged.withColumn("attempt", again)
        fresh = drawn(F.col("kind"), F.col("canon"), F.col("attempt"), key)
        now = pin(redrawn.withColumn("surrogate", F.when(F.col("settled"), F.col("surrogate")).otherwise(fresh)), "surrogates")
    raise RuntimeError(f"no distinct surrogates after {ROUNDS} rounds")


def with_surrogates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced, plus ``n_entities`` and ``kinds`` (distinct, sorted).

    ``key`` is the secret on which all surrogates depend. Null and empty texts stay as they are, with no
    entities. Rows equal in id and text are rebuilt alike; repeated and null ids are allowed. An empty
    table gives an empty result. Columns of the input that bear a name of the result are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    docs = docs.select(*kept)
    none = F.lit(0).cast("bigint").alias("n_entities"), F.array().cast("array<string>").alias("kinds")
    clean = docs.where(~suspected(F.col(text))).select(*kept, *none)
    # the columns of the input travel in one struct, out of the way of the names used here
    rest = [c for c in kept if c != text]
    cut = pin(
        docs.where(suspected(F.col(text))).select(
            F.struct(*rest).alias("_row"), pieces(F.col(text)).alias("_cut"), F.col("doc_id").cast("string").alias("_doc"),
            F.xxhash64("doc_id", text).alias("_hash"),
        ),
        "cut",
    )
    back = lambda new: [new.alias(c) if c == text else F.col("_row")[c].alias(c) for c in kept]
    spared = cut.where(F.size("_cut") == 1).select(*back(F.get("_cut", F.lit(0))), *none)
    held = cut.where(F.size("_cut") > 1)
    spots = pin(
        held.select("_doc", "_hash", F.posexplode(mentions(F.col("_cut"))).alias("at", "hit")).select("_doc", "_hash", "at", "hit.*").distinct(),
        "mentions",
    )
    entities = pin(distinct_entities(spots), "entities")
    settled = assigned(entities, key).withColumn("_group", group_of(F.col("kind")))
    pairs = spots.withColumn("_group", group_of(F.col("kind"))).drop("kind").join(settled, ["_group", "canon"])
    new = F.struct("at", poured(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new"), "kind")
    per_doc = pairs.groupBy(F.col("_doc").alias("_d"), F.col("_hash").alias("_h")).agg(F.sort_array(F.collect_list(new)).alias("_new"))
    same = held["_doc"].eqNullSafe(per_doc["_d"]) & (held["_hash"] == per_doc["_h"])
    rebuilt = F.array_join(F.transform("_cut", lambda p, i: F.when(i % 2 == 0, p).otherwise(F.get("_new", F.floor(i / 2).cast("int"))["new"])), "")
    kinds = F.array_sort(F.array_distinct(F.transform("_new", lambda x: x["kind"])))
    changed = held.join(per_doc, same).select(
        *back(rebuilt), F.size("_new").cast("bigint").alias("n_entities"), kinds.alias("kinds")
    )
    return clean.unionByName(spared).unionByName(changed)


def op4_surrogates(spark, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), key="emberlog-demo-key")
