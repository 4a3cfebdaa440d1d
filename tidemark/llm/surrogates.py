"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Detected: e-mail addresses, IPv4 addresses, long account numbers, IBANs, telephone
numbers, social security numbers, persons named with a title, and full names that
stand with a title in any document. An entity is a type and a normal form, so that one
number in two layouts, or a family name with and without a given name, in capitals or
not, stays one entity everywhere. Its surrogate follows from a keyed hash of
the entity and an attempt number.

The collision check runs over the distinct entities of all documents: two entities of
a type must not share a surrogate, and no surrogate may be an entity that occurs. An
entity that loses moves to its next attempt until no collision is left. Later attempts
make surrogates longer, so that a free one always exists. Only such
entities enter the table of attempts that documents are joined with; a document
without them derives its surrogates on the spot. That join is on a hash of the text
and sized by measurement.

Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.expressions import let, woven
from tidemark.session import materialize

KEY = "tidemark-demo-key"
# Attempts from which surrogates grow: letters of addresses and domains soon, numbers when their format is full.
GROW, GROW_NUMBERS = 3, 12

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
SSN = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ACCOUNT = "(?<![0-9])(?:[0-9][ -]?){12,18}[0-9](?![0-9])"
PHONE = (
    r"(?<![0-9A-Za-z])(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    # With blanks or without any layout, ten digits that no count of seconds and no padded number begins like.
    r"|[2-9][0-9]{2}\x20[0-9]{3}\x20[0-9]{4}|[2-9][0-9]{9}(?![A-Za-z]))(?![0-9])"
)
# Ten digits at least; in groups of four, or without blanks.
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}(?:[A-Z\x20]{0,6}[0-9]){10})[A-Z]{2}[0-9]{2}"
    r"(?:[A-Z0-9]{11,30}|\x20[A-Z0-9]{4}(?:\x20(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?:\x20(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
# Titles by gender. Those of neither gender leave it open.
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Monsieur", "господин", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "госпожа", "г-жа"),
    "n": ("Dr", "Prof"),
}
# An apostrophe and one letter at the end, as of a genitive, belong to no name.
_PART = r"\p{Lu}(?:['’]\p{L}[\p{L}\p{M}]*|[\p{L}\p{M}]+)(?:['’]\p{L}{2,})*"
_NAME = rf"{_PART}(?:-{_PART})?"
_INITIALS = r"(?:\p{Lu}\.\x20?|\p{Lu}\x20)*"


def _titles(words) -> str:
    return "(?:" + "|".join(sorted(words, key=len, reverse=True)) + ")"


PERSON = (
    rf"(?<![\p{{L}}\p{{N}}])({_titles(w for t in TITLES.values() for w in t)}\.?)\x20{_INITIALS}({_NAME})(?![\p{{L}}\p{{M}}])"
    rf"(?:\x20{_INITIALS}({_NAME})(?![\p{{L}}\p{{M}}]))?"
)
# A name and the one that follows it, initials between them or not; names overlap, so the second is only looked at.
PAIR = rf"(?<![\p{{L}}\p{{N}}'’-])({_NAME})(?![\p{{L}}\p{{M}}])(?=\x20{_INITIALS}({_NAME})(?![\p{{L}}\p{{M}}]))"
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, IPV4, SSN, IBAN, ACCOUNT, PHONE))
NAME_WORD = rf"(?<![\p{{L}}\p{{N}}'’-]){_NAME}(?![\p{{L}}\p{{N}}])"

# Syllables and endings by script; a surrogate name is built of them.
SYLLABLES = {
    "latin": ("ba be bo da de do ga go ka ke ko la le lo ma me mi mo na ne ni no pa po ra re ri ro sa se so ta te to va ve vi".split(), {"m": "n", "f": "a", "n": "e", "x": "er"}),
    "cyrillic": ("ба бе бо да де до га го ка ке ко ла ле ло ма ме ми мо на не ни но па по ра ре ри ро са се со та те то ва ве ви".split(), {"m": "н", "f": "а", "n": "е", "x": "ин"}),
    "greek": ("βα βε βο δα δε δο γα γο κα κε κο λα λε λο μα με μι μο να νε νι νο πα πο ρα ρε ρι ρο σα σε σο τα τε το".split(), {"m": "ος", "f": "α", "n": "ι", "x": "ης"}),
}


def stream(seed: Column, length: Column) -> Column:
    """``length`` numbers from 0 to 255 fixed by ``seed``."""
    blocks = F.sequence(F.lit(0), F.floor((length - 1) / 32).cast("int"))
    hexes = F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat(seed, F.lit("|"), b.cast("string")).cast("binary"), 256)), "")
    return let(
        hexes, lambda h: F.transform(F.sequence(F.lit(0), length - 1), lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    )


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn sum of an array of digits, the last one being the check digit."""
    doubled = lambda v: F.when(v > 4, v * 2 - 9).otherwise(v * 2)
    return F.aggregate(F.transform(F.reverse(digits), lambda v, i: F.when(i % 2 == 1, doubled(v)).otherwise(v)), F.lit(0), lambda a, v: a + v) % 10


def _letters(norm: Column, numbers: Column) -> Column:
    """Characters replaced by ones of their class; all else stays."""
    small, large, figures = (F.lit(x) for x in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
    one = lambda c, b: (
        F.when(c.between("0", "9"), F.substring(figures, b % 10 + 1, F.lit(1)))
        .when(c.between("a", "z"), F.substring(small, b % 26 + 1, F.lit(1)))
        .when(c.between("A", "Z"), F.substring(large, b % 26 + 1, F.lit(1)))
        .otherwise(c)
    )
    return F.array_join(F.zip_with(_chars(norm), numbers, one), "")


def _mod97(text: Column) -> Column:
    """Remainder of the number that digits and letters (A is 10) of a text make."""
    step = lambda a, c: F.when(c.between("0", "9"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(_chars(text), F.lit(0), step)


def _more(numbers: Column, attempt: Column, after: int, alphabet: str) -> Column:
    """Nothing before attempt ``after``, then one character more at each."""
    count = F.least(F.greatest(attempt - (after - 1), F.lit(0)), F.lit(24))
    pick = lambda b: F.substring(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))
    return F.array_join(F.transform(F.slice(F.reverse(numbers), F.lit(1), count), pick), "")


def _name(norm: Column, kind: Column, numbers: Column, attempt: Column) -> Column:
    """Syllables of the name's script and the ending of its gender, more of them at later attempts."""
    of = F.when(norm.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(norm.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))
    parts = F.create_map(*(x for k, (s, _) in SYLLABLES.items() for x in (F.lit(k), F.array(*map(F.lit, s)))))
    ends = F.create_map(*(x for k, (_, e) in SYLLABLES.items() for g, v in e.items() for x in (F.lit(f"{k}{g}"), F.lit(v))))
    gender = F.substring(kind, -1, 1)
    count = F.least(F.lit(4) + F.floor(attempt / 4).cast("int"), F.lit(20))
    return let(
        of,
        lambda s: F.concat(
            F.array_join(F.transform(F.slice(numbers, F.lit(1), count), lambda b: let(F.element_at(parts, s), lambda p: F.element_at(p, b % F.size(p) + 1))), ""),
            F.element_at(ends, F.concat(s, gender)),
        ),
    )


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Surrogate of a normal form. ``kind`` is email, domain, ip, ssn, account, iban, phone, given_m/f/n or family_x; names are in lower case."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm)

    def made(b: Column) -> Column:
        joined = lambda a: F.array_join(F.transform(a, lambda v: v.cast("string")), "")
        size = F.length(norm)
        private = norm.rlike(r"^(10\.|127\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)")
        # Outside private nets, the range that is reserved and never routed.
        ip = F.concat_ws(".", F.when(private, F.lit("10")).otherwise((b[0] % 15 + 240).cast("string")), *(b[i].cast("string") for i in (1, 2, 3)))
        # Area numbers from 900 on are not issued.
        ssn = F.concat(F.lit("9"), joined(F.transform(F.slice(b, 1, 8), lambda v: v % 10)))
        phone = joined(F.transform(F.slice(b, F.lit(1), size), lambda v, i: F.when((size == 10) & ((i == 0) | (i == 3)), v % 8 + 2).otherwise(v % 10)))
        own = F.transform(_chars(norm), lambda c: c.cast("int"))
        first = F.concat(F.slice(own, 1, 1), F.transform(F.slice(b, F.lit(2), size - 2), lambda v: v % 10))
        # The check digit is right if that of the original is.
        check = lambda d: F.pmod(10 - luhn(F.concat(d, F.array(F.lit(0)))) + F.when(luhn(own) == 0, 0).otherwise(1 + b[0] % 9), F.lit(10))
        account = let(first, lambda d: joined(F.concat(d, F.array(check(d).cast("int")))))
        # Country kept, check digits right.
        rest = _letters(F.substring(norm, F.lit(5), size), b)
        iban = let(rest, lambda r: F.concat(F.substring(norm, 1, 2), F.lpad((98 - _mod97(F.concat(r, F.substring(norm, 1, 2), F.lit("00")))).cast("string"), 2, "0"), r))
        letters = _more(b, attempt, GROW, "abcdefghijklmnopqrstuvwxyz")
        figures = _more(b, attempt, GROW_NUMBERS, "0123456789")
        return (
            F.when(kind == "email", F.concat(_letters(F.substring_index(norm, "@", 1), b), letters, F.lit("@"), domain_of(norm)))
            .when(kind == "domain", F.concat(_letters(F.regexp_replace(norm, r"\.[^.]*$", ""), b), letters, F.lit(".example")))
            .when(kind == "ip", F.concat(ip, F.when(figures != "", F.concat(F.lit("."), figures)).otherwise("")))
            .when(kind == "ssn", F.concat(ssn, figures))
            .when(kind == "account", F.concat(account, figures))
            .when(kind == "iban", F.concat(iban, figures))
            .when(kind == "phone", F.concat(phone, figures))
            .otherwise(_name(norm, kind, b, attempt))
        )

    return let(stream(seed, F.greatest(F.length(norm), F.lit(24))), made)


_ENTITY = "struct<kind:string,norm:string>"


def classify(match: Column) -> Column:
    """Kind and normal form of a match of ``ENTITY``."""
    number = digits_of(match)
    kind = (
        F.when(match.contains("@"), "email")
        .when(match.rlike(f"^(?:{_OCTET}\\.){{3}}{_OCTET}$"), "ip")
        .when(match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(match.rlike("^[A-Z]"), "iban")
        .when(match.rlike("^(?:[0-9][ -]?){12,18}[0-9]$"), "account")
        .otherwise("phone")
    )
    norm = (
        F.when(kind == "email", F.lower(match))
        .when(kind == "ip", match)
        .when(kind == "iban", F.replace(match, F.lit(" "), F.lit("")))
        .when(kind == "phone", F.substring(number, F.greatest(F.length(number) - 9, F.lit(1)), F.lit(10)))
        .otherwise(number)
    )
    return F.struct(kind.alias("kind"), norm.alias("norm"))


def domain_of(email: Column) -> Column:
    return F.substring_index(email, "@", -1)


def laid_out(match: Column, digits: Column, places_of: str = "[0-9]") -> Column:
    """The digits put in the places of the last digits of ``match``; those beyond its places follow it."""

    def lay(pieces: Column) -> Column:
        places = F.size(pieces) - 1
        kept = F.greatest(places - F.length(digits), F.lit(0))
        old = F.concat(F.slice(F.regexp_extract_all(match, F.lit(places_of), F.lit(0)), F.lit(1), kept), _chars(F.substring(digits, F.lit(1), places)))
        return F.concat(woven(pieces, old), F.substring(digits, places + 1, F.length(digits)))

    return let(F.split(match, places_of, -1), lay)


def person_parts(text: Column) -> Column:
    """Array of entities of the persons with a title."""
    groups = [F.regexp_extract_all(text, F.lit(PERSON), F.lit(g)) for g in (1, 2, 3)]

    def of(p: Column) -> Column:
        title = F.regexp_replace(p["0"], r"\.$", "")
        gender = F.when(title.rlike(f"^{_titles(TITLES['m'])}$"), "m").when(title.rlike(f"^{_titles(TITLES['f'])}$"), "f").otherwise("n")
        two = F.length(p["2"]) > 0
        family = F.struct(F.lit("family_x").alias("kind"), F.lower(F.when(two, p["2"]).otherwise(p["1"])).alias("norm"))
        given = F.struct(F.concat(F.lit("given_"), gender).alias("kind"), F.lower(p["1"]).alias("norm"))
        return F.when(two, F.array(given, family)).otherwise(F.array(family))

    return F.flatten(F.transform(F.arrays_zip(*groups), of)).cast(f"array<{_ENTITY}>")


_FULL = "struct<given:string,family:string>"


def pairs_of(text: Column) -> Column:
    """Distinct pairs of names in a row, in lower case: a full name may be among them."""
    groups = [F.regexp_extract_all(text, F.lit(PAIR), F.lit(g)) for g in (1, 2)]
    pair = lambda p: F.struct(F.lower(p["0"]).alias("given"), F.lower(p["1"]).alias("family"))
    found = F.array_distinct(F.transform(F.arrays_zip(*groups), pair)).cast(f"array<{_FULL}>")
    return F.when(text.rlike(PAIR), found).otherwise(F.array().cast(f"array<{_FULL}>"))


def full_names(text: Column) -> Column:
    """Array of the full names with a title: kind of the given name, given and family name."""
    parts = person_parts(text)
    kind_of = "array<struct<kind:string,given:string,family:string>>"
    # A given name stands right before its family name.
    both = let(parts, lambda p: F.filter(F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), _full), lambda x: x.isNotNull()))
    return F.when(text.rlike(PERSON), F.array_distinct(both).cast(kind_of)).otherwise(F.array().cast(kind_of))


def _full(given: Column, family: Column) -> Column:
    full = F.struct(given["kind"].alias("kind"), given["norm"].alias("given"), family["norm"].alias("family"))
    return F.when(given["kind"].startswith("given_"), full)


def entities_of(text: Column) -> Column:
    """Distinct entities of a text."""
    none = F.array().cast(f"array<{_ENTITY}>")
    plain = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), classify)
    domains = lambda found: F.transform(
        F.filter(found, lambda e: e["kind"] == "email"), lambda e: F.struct(F.lit("domain").alias("kind"), domain_of(e["norm"]).alias("norm"))
    )
    plain = F.when(text.rlike(ENTITY), let(plain, lambda f: F.concat(f, domains(f))).cast(f"array<{_ENTITY}>")).otherwise(none)
    persons = F.when(text.rlike(PERSON), person_parts(text)).otherwise(none)
    return F.array_distinct(F.concat(plain, persons))


def _attempt(attempts: Column, kind: Column, norm: Column) -> Column:
    return F.coalesce(F.element_at(attempts, F.concat(kind, F.lit("|"), norm)), F.lit(0))


def replaced(text: Column, found: Column, attempts: Column, key: str) -> Column:
    """``text`` with its entities replaced; ``attempts`` maps ``kind|norm`` to an attempt number."""

    def plain(match: Column) -> Column:
        def new(e: Column) -> Column:
            made = surrogate(e["kind"], e["norm"], _attempt(attempts, e["kind"], e["norm"]), key)
            domain = domain_of(e["norm"])
            there = surrogate(F.lit("domain"), domain, _attempt(attempts, F.lit("domain"), domain), key)
            mail = F.concat_ws("@", F.substring_index(made, "@", 1), there)
            return (
                F.when(e["kind"] == "email", F.when(match == F.upper(match), F.upper(mail)).otherwise(mail))
                .when(e["kind"] == "ip", made)
                .when(e["kind"] == "iban", laid_out(match, made, "[A-Z0-9]"))
                .otherwise(laid_out(match, made))
            )

        return let(classify(match), new)

    def names(t: Column) -> Column:
        people = F.filter(found, lambda e: e["kind"].startswith("given_") | (e["kind"] == "family_x"))

        def word(people: Column):
            def swap(match: Column) -> Column:
                known = F.filter(people, lambda e: e["norm"] == F.lower(match))
                cased = lambda new: F.when(match == F.upper(match), F.upper(new)).otherwise(F.initcap(new))
                made = lambda e: let(surrogate(e["kind"], e["norm"], _attempt(attempts, e["kind"], e["norm"]), key), cased)
                return F.when(F.size(known) > 0, let(F.element_at(known, 1), made)).otherwise(match)

            return woven(F.split(t, NAME_WORD, -1), F.transform(F.regexp_extract_all(t, F.lit(NAME_WORD), F.lit(0)), swap))

        return let(people, lambda p: F.when(F.size(p) > 0, word(p)).otherwise(t))

    cut = lambda t: F.when(
        t.rlike(ENTITY), woven(F.split(t, ENTITY, -1), F.transform(F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)), plain))
    ).otherwise(t)
    return let(cut(text), names)


def attempts_table(entities: DataFrame, key: str) -> DataFrame:
    """Entities (``kind``, ``norm``) that need another attempt than the first, with its number.

    ``entities`` holds each entity once. Of entities with one surrogate, that with the
    lowest attempt keeps it, ties by normal form.
    """
    taken = entities.withColumnRenamed("norm", "sur")
    state = entities.withColumn("attempt", F.lit(0))
    while True:
        state = materialize(state.withColumn("sur", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "surrogates")
        first = state.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "norm")).alias("first"))
        clash = state.join(first, ["kind", "sur"]).where(F.struct("attempt", "norm") != F.col("first")).select("kind", "norm")
        clash = materialize(clash.union(state.join(taken, ["kind", "sur"], "left_semi").select("kind", "norm")).distinct(), "collisions")
        if clash.isEmpty():
            return materialize(state.where("attempt > 0").select("kind", "norm", "attempt"), "attempts")
        state = state.drop("sur").join(clash.withColumn("moved", F.lit(1)), ["kind", "norm"], "left")
        state = state.select("kind", "norm", (F.col("attempt") + F.coalesce("moved", F.lit(0))).alias("attempt"))


def people_without_title(docs: DataFrame, text: Column, found: DataFrame) -> DataFrame:
    """``tkey`` and ``e``: entities of the full names of a text that some text has with a title.

    The full names are made distinct first; of several genders one is taken everywhere.
    """
    full = found.select(F.explode("full").alias("f")).select("f.*").groupBy("given", "family").agg(F.min("kind").alias("kind"))
    full = materialize(full, "full-names")
    rows = docs.select(F.md5(text.cast("binary")).alias("tkey"), pairs_of(text).alias("pairs"))
    met = rows.select("tkey", F.explode("pairs").alias("p")).select("tkey", "p.*").distinct()
    if full.isEmpty():
        met = met.where(F.lit(False))
    met = met.join(full, ["given", "family"])
    given = F.struct("kind", F.col("given").alias("norm"))
    family = F.struct(F.lit("family_x").alias("kind"), F.col("family").alias("norm"))
    return materialize(met.select("tkey", F.explode(F.array(given, family).cast(f"array<{_ENTITY}>")).alias("e")).distinct(), "untitled")


def pseudonymize(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", key: str = KEY) -> DataFrame:
    """All documents, all columns, with surrogates in the text, and ``n_entities``.

    Equal entities get equal surrogates in all documents, distinct ones distinct
    surrogates. Names without a title are replaced where the same text has them with
    one, and full names, given and family name, where any text has them with one. A null text stays null and has no entities; repeated rows stay repeated; an
    empty table gives an empty result. Where a text changed, ``length_col`` gets its
    new length. A column that is already called ``n_entities`` is replaced.
    """
    text = F.col(text_col)
    found = docs.select(F.md5(text.cast("binary")).alias("tkey"), entities_of(text).alias("ents"), full_names(text).alias("full"))
    found = materialize(found.where(F.size("ents") > 0), "entities")
    entities = found.select(F.explode("ents").alias("e")).select("e.*").distinct()
    later = attempts_table(materialize(entities, "entity-table"), key)
    others = people_without_title(docs, text, found)
    # A text that many documents share counts once; texts without later attempts drop out.
    own = found.dropDuplicates(["tkey"]).select("tkey", F.explode("ents").alias("e"))
    needed = own.union(others).select("tkey", "e.*").distinct().join(later, ["kind", "norm"])
    pair = F.struct(F.concat_ws("|", "kind", "norm").alias("k"), F.col("attempt").alias("v"))
    maps = needed.groupBy("tkey").agg(F.map_from_entries(F.collect_list(pair)).alias("attempts"))
    maps = materialize(maps.join(others.groupBy("tkey").agg(F.array_sort(F.collect_set("e")).alias("others")), "tkey", "full"), "attempt-maps")
    names = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), F.md5(text.cast("binary")).alias("tkey"))
    rows = rows.join(maps, "tkey", "left")
    old = F.col("doc").getField(text_col)
    attempts = F.coalesce("attempts", F.create_map().cast("map<string,int>"))
    rows = rows.select("doc", attempts.alias("attempts"), "others", F.when(old.isNotNull(), entities_of(old)).alias("ents"))
    person = lambda e: e["kind"].startswith("given_") | (e["kind"] == "family_x")
    # What the text itself says of a name goes first.
    more = F.filter("others", lambda o: ~F.exists("ents", lambda e: person(e) & (e["norm"] == o["norm"])))
    rows = rows.withColumn("ents", F.when(F.size("others") > 0, F.concat("ents", more)).otherwise(F.col("ents")))
    new = F.when(F.size("ents") > 0, replaced(old, F.col("ents"), F.col("attempts"), key)).otherwise(old)
    rows = rows.select("doc", new.alias("new"), F.coalesce(F.size("ents"), F.lit(0)).cast("long").alias("n"))
    out = {text_col: F.col("new")}
    if length_col in names:
        length = F.col("doc").getField(length_col)
        out[length_col] = F.when(~F.col("new").eqNullSafe(old), F.length("new").cast(docs.schema[length_col].dataType)).otherwise(length)
    return rows.select(*(out.get(c, F.col("doc").getField(c)).alias(c) for c in names), F.greatest("n", F.lit(0).cast("long")).alias("n_entities"))
