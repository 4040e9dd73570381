"""Personal data replaced by keyed surrogates.

Every detected entity gets a replacement of its own type and format: digits stay digits in
their grouping, addresses stay addresses, names keep gender, script and case. The replacement
is a function of a secret key, the entity's type and its canonical value, so all mentions of an
entity get the same one, in every document. Names are mapped word by word, so "Ms Ada Byron" and
"Ms Byron" still share a surname; the gender of a given name comes from all its mentions, not from
the one at hand; and a capitalised word that is a detected name of the same text is replaced where
it stands alone, too. Mailbox and host of an address are entities of their own. A check over all distinct entities finds replacements that
two entities share or that equal a real entity; those move to their next candidate until all
are distinct and new. Where a format has too few values for that, candidates get wider.

Scale: documents are scanned where they lie; only mentions are shuffled to be mapped. Distinct
entities stay a distributed table, and the check is a grouped count and a join on it. A mention
that fills a third of the corpus is one row there, and AQE splits its join. Texts move once, to
meet their replacements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

# Titles and given names that mark a person, with their gender.
TITLES = {"m": ["Mr", "Herr", "Señor", "Sr", "Don", "Monsieur", "Господин"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Doña", "Madame", "Mme", "Mlle", "Госпожа"],
          "n": ["Dr", "Prof"]}
GIVEN = {"m": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter", "Paul", "Hans",
               "Jürgen", "Klaus", "Pierre", "Jean", "Jacques", "Carlos", "José", "Juan", "Miguel", "Иван", "Сергей"],
         "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Emma", "Ursula",
               "Sabine", "Petra", "Marie", "Camille", "Sophie", "María", "Carmen", "Ana", "Lucía", "Анна", "Ольга"]}
#: Syllables and gendered endings that surrogates of names are made from, by script.
SYLLABLES = {"latin": (["ba", "ce", "di", "fo", "gu", "la", "me", "ni", "ro", "su", "ta", "ve", "wi", "jo", "ka", "lin"],
                       {"m": ["n", "r", "s", "k"], "f": ["a", "ia", "ina", "ela"], "n": ["o", "en", "is", "ey"]}),
             "cyrillic": (["ба", "ве", "ди", "го", "лу", "ма", "не", "ри", "со", "ту", "ка", "зи"],
                          {"m": ["н", "р", "л", "й"], "f": ["а", "ия", "ина", "ела"], "n": ["о", "ен", "ис", "ко"]}),
             "greek": (["βα", "δε", "φι", "γο", "λυ", "μα", "νε", "ρι", "σο", "τα", "κε", "πι"],
                       {"m": ["ος", "ης", "ας", "ων"], "f": ["α", "ια", "ινα", "η"], "n": ["ου", "ι", "ιδη", "εα"]})}

_WORD = "\\p{Lu}[\\p{L}'’-]++"
_OCTET = "(?:25[0-5]|2[0-4]\\d|1?\\d?\\d)"
_FIRST = "".join(sorted({c for g in (TITLES, GIVEN) for ws in g.values() for w in ws for c in (w[0], w[0].lower())}))
_HEX = "[0-9A-Fa-f]{1,4}"
#: type -> pattern, first match wins at any place. Quantifiers are possessive or bounded, and a
#: look at the first characters lets most places fail at once.
PATTERNS = {
    "email": "(?<![\\w.%+-])[\\w.%+-]++@[\\w-]++(?:\\.[\\w-]++)+",
    "secret": "(?<=[=:]\\s{0,2}[\"']?)(?<=(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\\s{0,2}[=:]\\s{0,2}[\"']?)[^\\s\"',;]{4,}+"
              "|(?=[Aegs])\\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_\\w{20,}+|sk-\\w{20,}+|eyJ[\\w-]{10,}+\\.[\\w.-]++)",
    "iban": "(?=[A-Z]{2}\\d)(?<!\\w)[A-Z]{2}\\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\\w)",
    "ip": f"(?=\\d)(?<![\\d.])(?:{_OCTET}\\.){{3}}{_OCTET}(?!\\d|\\.\\d)",
    "ip6": f"(?=[0-9A-Fa-f:]{{1,4}}:)(?<![\\w:.])(?=[0-9A-Fa-f:]*\\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\\w:])",
    "ssn": "(?=\\d)(?<![\\d-])\\d{3}-\\d{2}-\\d{4}(?![\\d-])",
    "phone": "(?=[0-9+(])(?<![\\w+])(?:\\+\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)|\\d{1,4})(?:[ .-]?\\d{2,4}){2,4}|(?:\\(\\d{3}\\) ?|\\d{3}[ .-])\\d{3}[ .-]\\d{4})(?!\\d)",
    "card": "(?=\\d)(?<![\\w+-])\\d(?:[ -]?\\d){12,18}(?![\\w])",
    "person": f"(?=[{_FIRST}])(?<![\\p{{L}}])(?:(?iu:{'|'.join(t for g in TITLES.values() for t in g)})\\.? {_WORD}(?: {_WORD}){{0,2}}"
              f"|(?:{'|'.join(n for g in GIVEN.values() for n in g)}) {_WORD})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity holds: texts without it are passed over.
HINT = f"[0-9@=:]|AKIA|gh[pousr]_|sk-|eyJ|{PATTERNS['person']}"
_DIGITS = ("phone", "card", "ssn")
_OWN = "['’][sS]\\z"
#: So many candidates keep the value's format; later ones are wider by WIDER digits each.
IN_FORMAT, WIDER = 8, 4


def _kind(e: Column) -> Column:
    """Type of a matched entity: the first pattern that matches all of it. What stands before a
    secret is not part of the match, so a secret is what no other pattern explains."""
    out = F.lit("secret")
    for kind in reversed([k for k in PATTERNS if k != "secret"]):
        out = F.when(F.regexp_like(e, F.lit(f"\\A(?:{PATTERNS[kind]})\\z")), kind).otherwise(out)
    return out


def _one_of(word: Column, lists: dict[str, list[str]]) -> Column:
    """Gender of the list that holds ``word`` in any case, or null."""
    out = F.lit(None).cast("string")
    for gender, words in lists.items():
        out = F.when(F.lower(word).isin([w.lower() for w in words]), gender).otherwise(out)
    return out


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, th, pos, part, glue, kind, shown, value, gender): each entity of each text, names in words,
    addresses in mailbox and host; ``glue`` joins the parts. ``value`` is canonical. ``kind`` "kept" stays as
    it is: titles, and digits that are no card as their check digit is wrong."""
    found = (docs.where(F.regexp_like("text", F.lit(HINT)))
             .select("doc_id", F.xxhash64("text").alias("th"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found"))
             .select("doc_id", "th", F.posexplode("found").alias("pos", "e"))
             .withColumn("whole", _kind(F.col("e"))))
    e, whole = F.col("e"), F.col("whole")
    words = (F.when(whole == "person", F.split(e, " "))
             .when(whole == "email", F.array(F.substring_index(e, "@", 1), F.substring_index(e, "@", -1))).otherwise(F.array(e)))
    parts = found.withColumn("words", words).select(
        "doc_id", "th", "pos", "whole", "e", "words", F.posexplode("words").alias("part", "shown"))
    title, last = _one_of(F.rtrim(F.get("words", F.lit(0)), F.lit(".")), TITLES), F.col("part") == F.size("words") - 1
    digits = F.regexp_replace("shown", "\\D", "")
    kind = (F.when(whole == "email", F.when(F.col("part") == 0, "mailbox").otherwise("host"))
            .when((whole == "card") & (_luhn(F.when(whole == "card", digits).otherwise("0")) % 10 != 0), "kept")
            .when(whole != "person", whole)
            .when((F.col("part") == 0) & title.isNotNull(), "kept")
            .when(last, "surname").otherwise("given"))
    name = F.lower(F.regexp_replace("shown", _OWN, ""))
    value = (F.when(F.col("kind").isin(*_DIGITS), digits).when(F.col("kind") == "mailbox", F.lower(e))
             .when(F.col("kind").isin("secret", "iban"), F.col("shown"))
             .when(F.col("kind").isin("given", "surname"), name).otherwise(F.lower("shown")))
    gender = F.when(F.col("kind") == "given", F.coalesce(_one_of(F.col("shown"), GIVEN), F.when(title != "n", title)))
    glue = F.when(whole == "email", "@").otherwise(" ")
    return parts.withColumn("kind", kind).select("doc_id", "th", "pos", "part", glue.alias("glue"), "kind", "shown",
                                                 value.alias("value"), gender.alias("gender"))


def entities(found: DataFrame) -> DataFrame:
    """(kind, value, gender): the distinct entities; the gender of a given name is the one that more of
    its mentions tell, "n" if neither."""
    men, women = (F.count_if(F.col("gender") == g) for g in ("m", "f"))
    gender = F.when(men > women, "m").when(women > men, "f").otherwise("n")
    return found.where("kind <> 'kept'").groupBy("kind", "value").agg(gender.alias("gender"))


def _pick(seed: Column, i: Column | int, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, F.lit(i) if isinstance(i, int) else i), F.lit(n)).cast("int")


def _letter(seed: Column, i: Column, letters: str) -> Column:
    return F.substring(F.lit(letters), _pick(seed, i, len(letters)) + 1, F.lit(1))


def _same_classes(value: Column, seed: Column, fill: bool = False) -> Column:
    """Digits for digits, letters for letters of the same case (hexadecimal stays so; small ones
    for letters without case), the rest kept. ``fill``: a value of marks alone becomes letters."""
    hexadecimal = F.regexp_like(value, F.lit("\\A[0-9a-fA-F:]+\\z"))
    marks = ~F.regexp_like(value, F.lit("[\\p{L}\\p{N}]")) if fill else F.lit(False)
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def char(c: Column, i: Column) -> Column:
        return (F.when(F.regexp_like(c, F.lit("[0-9]")), _letter(seed, i, "0123456789"))
                .when(F.regexp_like(c, F.lit("\\p{Ll}")), F.when(hexadecimal, _letter(seed, i, low[:6])).otherwise(_letter(seed, i, low)))
                .when(F.regexp_like(c, F.lit("\\p{Lu}")), F.when(hexadecimal, _letter(seed, i, up[:6])).otherwise(_letter(seed, i, up)))
                .when(F.regexp_like(c, F.lit("\\p{N}")), _letter(seed, i, "0123456789"))
                .when(F.regexp_like(c, F.lit("\\p{L}")) | marks, _letter(seed, i, low)).otherwise(c))

    return F.array_join(F.transform(F.split(value, ""), char), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check over a string of digits (valid: a multiple of ten)."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
                          .otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _name(value: Column, gender: Column, seed: Column, attempt: Column) -> Column:
    """Syllables of the value's script, one more every eighth attempt, and an ending of the gender."""
    def of(script: str) -> Column:
        syllables, endings = SYLLABLES[script]
        stem = F.array_join(F.transform(
            F.sequence(F.lit(0), 2 + F.floor(attempt / 8).cast("int")),
            lambda i: F.get(F.array(*map(F.lit, syllables)), _pick(seed, i, len(syllables)))), "")
        tail = F.lit("")
        for each, ends in endings.items():
            tail = F.when(gender == each, F.get(F.array(*map(F.lit, ends)), _pick(seed, -1, len(ends)))).otherwise(tail)
        return F.concat(stem, tail)

    return (F.when(F.regexp_like(value, F.lit("\\p{IsCyrillic}")), of("cyrillic"))
            .when(F.regexp_like(value, F.lit("\\p{IsGreek}")), of("greek")).otherwise(of("latin")))


def surrogate(key: str, kind: Column, value: Column, gender: Column, attempt: Column) -> Column:
    """Candidate number ``attempt`` for an entity, in canonical form. The gender picks the ending only."""
    def seeded(what: Column) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, what, attempt.cast("string")), 256)

    def wider(seed: Column) -> Column:
        return F.left(F.translate(seed, "abcdef", "012345"), F.greatest(attempt - (IN_FORMAT - 1), F.lit(0)) * WIDER)

    def digits(seed: Column) -> Column:
        same = F.concat(F.substring(value, 1, 1), _same_classes(F.substr(value, F.lit(2)), seed), wider(seed))
        check = F.concat(F.left(same, F.length(same) - 1), F.lit("0"))
        luhn = F.concat(F.left(same, F.length(same) - 1), F.pmod(10 - _luhn(check) % 10, F.lit(10)).cast("string"))
        return F.when((kind == "card") & (_luhn(value) % 10 == 0), luhn).otherwise(same)

    def mailbox(seed: Column) -> Column:
        return F.concat(_same_classes(F.substring_index(value, "@", 1), seed), wider(seed), F.lit("@"), F.substring_index(value, "@", -1))

    def host(seed: Column) -> Column:
        top = F.substring_index(value, ".", -1)
        return F.concat(_same_classes(F.left(value, F.length(value) - F.length(top) - 1), seed), wider(seed), F.lit("."), top)

    def any_kind(seed: Column) -> Column:
        octets = F.concat_ws(".", (_pick(seed, 0, 223) + 1).cast("string"), _pick(seed, 1, 256).cast("string"),
                             _pick(seed, 2, 256).cast("string"), (_pick(seed, 3, 254) + 1).cast("string"))
        groups = F.regexp_replace(F.left(seed, F.lit(32)), "(.{4})(?=.)", "$1:")     # no address is wider than this
        return (F.when(kind.isin(*_DIGITS), digits(seed)).when(kind == "mailbox", mailbox(seed)).when(kind == "host", host(seed))
                .when(kind.isin("ip", "ip6") & (attempt >= IN_FORMAT), groups).when(kind == "ip", octets)
                .when(kind == "iban", F.concat(F.left(value, F.lit(2)), _same_classes(F.substr(value, F.lit(3)), seed), wider(seed)))
                .when(kind.isin("surname", "given"), _name(value, gender, seed, attempt))
                .otherwise(F.concat(_same_classes(value, seed, fill=True), wider(seed))))

    return let(seeded(value), any_kind)


def assign(known: DataFrame, key: str) -> DataFrame:
    """(kind, value, new): a replacement for each distinct entity (kind, value, gender); within a kind no
    two are equal and none is the value of an entity. It ends for any input: the entities stay as
    many as they are, and each round past IN_FORMAT (names: each eighth) multiplies the values
    that a candidate can have."""
    known = written(known.select("kind", "value", "gender", F.lit(0).alias("attempt")), "entities")
    originals = known.select(F.col("kind").alias("o_kind"), F.col("value").alias("o_value"))
    while True:
        tried = written(known.withColumn("new", surrogate(key, F.col("kind"), F.col("value"), F.col("gender"), F.col("attempt"))), "surrogates")
        shared = (tried.groupBy("kind", "new").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first")).where("n > 1")
                  .select(F.col("kind").alias("s_kind"), F.col("new").alias("s_new"), "first"))
        marked = (tried.join(shared, (F.col("kind") == F.col("s_kind")) & (F.col("new") == F.col("s_new")), "left")
                  .join(originals, (F.col("kind") == F.col("o_kind")) & (F.col("new") == F.col("o_value")), "left"))
        clash = (F.col("first").isNotNull() & (F.col("value") != F.col("first"))) | F.col("o_value").isNotNull()
        marked = written(marked.select("kind", "value", "gender", "new", "attempt", clash.alias("clash")), "checked")
        if marked.where("clash").isEmpty():
            return marked.select("kind", "value", "new")
        known = marked.select("kind", "value", "gender", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))


def _shown(shown: Column, kind: Column, new: Column) -> Column:
    """The replacement in the mention's own format: digit groups (more digits go behind), capitals."""
    regrouped = F.aggregate(
        F.split(shown, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("next")),
        lambda s, c: F.when(F.regexp_like(c, F.lit("[0-9]")), F.struct(
            F.concat(s["out"], F.substr(new, s["next"], F.lit(1))).alias("out"), (s["next"] + 1).alias("next")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["next"].alias("next"))),
        lambda s: F.concat(s["out"], F.substr(new, s["next"])))
    return (F.when(kind == "kept", shown).when(kind.isin(*_DIGITS), regrouped)
            .when(kind.isin("surname", "given"), _cased(shown, new))
            .when(kind == "mailbox", F.substring_index(new, "@", 1)).otherwise(new))


def _cased(shown: Column, new: Column) -> Column:
    """A name in the capitals of the mention; what shows possession stays behind it."""
    bare = F.regexp_replace(shown, _OWN, "")
    cased = F.when((bare == F.upper(bare)) & (F.length(bare) > 1), F.upper(new)).otherwise(F.initcap(new))
    return F.concat(cased, F.regexp_extract(shown, _OWN, 0))


def _alone(gap: Column, names: Column) -> Column:
    """Text between entities with the text's detected names replaced where they stand alone."""
    def word(t: Column) -> Column:
        new = F.get(F.filter(names, lambda x: x["value"] == F.lower(F.regexp_replace(t, _OWN, ""))), F.lit(0))["new"]
        return F.when(F.regexp_like(t, F.lit("\\A\\p{Lu}")), F.coalesce(_cased(t, new), t)).otherwise(t)
    return F.array_join(F.transform(F.regexp_extract_all(gap, F.lit("[\\p{L}'’-]++|[^\\p{L}'’-]++"), F.lit(0)), word), "")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id``, ``n_entities``, ``clean_text`` and ``row`` (a struct of all columns of the input,
    so no name can clash) for every row of ``docs``.

    Null text stays null and empty text empty; a text without entities is returned as it is.
    Null ``doc_id`` and repeated rows: replaced like any other. Empty table: no rows.
    """
    found = written(mentions(docs), "mentions")
    mapping = assign(entities(found), key)
    mapped = found.join(mapping.select(F.col("kind").alias("m_kind"), F.col("value").alias("m_value"), "new"),
                        (F.col("kind") == F.col("m_kind")) & (F.col("value") == F.col("m_value")), "left")
    parts = mapped.select("doc_id", "th", "pos", "part", "glue", (F.col("kind") != "kept").alias("real"),
                          _shown(F.col("shown"), F.col("kind"), F.col("new")).alias("s"),
                          F.when(F.col("kind").isin("given", "surname"), F.struct("value", "kind", "new")).alias("name")).repartition("doc_id", "th")
    in_order = F.transform(F.sort_array(F.collect_set(F.struct("part", "s"))), lambda x: x["s"])
    words = parts.groupBy("doc_id", "th", "pos").agg(
        F.when(F.max("glue") == "@", F.array_join(in_order, "@")).otherwise(F.array_join(in_order, " ")).alias("s"),
        F.max("real").alias("real"), F.collect_set("name").alias("names"))
    new = (words.groupBy(F.col("doc_id").alias("n_id"), F.col("th").alias("n_th"))       # a text's own mentions
           .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "s"))), lambda x: x["s"]).alias("new"),
                F.count_if("real").alias("n_real"), F.array_distinct(F.flatten(F.collect_list("names"))).alias("names")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # a word that is a given name and a surname counts as the given name
    names = F.sort_array(F.transform("names", lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"), x["new"].alias("new"))))
    gaps = F.split(F.col("row.text"), ANY, -1)
    gaps = F.when(F.size("names") > 0, F.transform(gaps, lambda g: _alone(g, names))).otherwise(gaps)
    text = F.array_join(F.zip_with(gaps, F.concat("new", F.array(F.lit(""))), lambda g, s: F.concat(g, s)), "")
    return (rows.join(new, F.col("doc_id").eqNullSafe(F.col("n_id")) & (F.col("th") == F.col("n_th")), "left")
            .select("doc_id", F.coalesce("n_real", F.lit(0)).cast("long").alias("n_entities"),
                    F.when(F.col("new").isNull(), F.col("row.text")).otherwise(text).alias("clean_text"), "row"))
