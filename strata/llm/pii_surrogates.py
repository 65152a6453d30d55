"""PII replacement by surrogates.

Entities (e-mail, phone, card, national id, passport, account, date of birth, street
address, IP address, secret, token, private key, person with a title or a common given
name) are found in whole texts and replaced by made-up values of the same
type and format: separators, length, letter case, country code, check digit,
private network, title, gender and script stay; the identifying characters are
drawn from a keyed hash of the normalised entity. The same entity therefore
gets the same surrogate in every document, however it is written (coreference). A
person found in a text is also found where the text names them again without title or
by the surname alone, and keeps their surrogate there. Digit runs that are no card
(13 to 19 digits without a valid check digit, other than 16) stay.

Distinctness is checked on the whole table: two entities must not share a
surrogate, and no surrogate may be an entity that occurs. An entity that fails
draws again with a higher attempt number until none does. Every WIDEN_EVERY
attempts the values to draw from become more (another digit, a longer surname,
further private octets), so that dense tables come to an end too. Attempts above zero
are rare and tested against an index of all settled values; only texts that hold such an entity take part in the join that brings
them in. Everything is SQL functions: texts are not shuffled for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

#: For tests and checks only: whoever knows the key can test a guess of a replaced value.
PUBLIC_KEY = "surrogates-v1"
#: After so many attempts an entity draws from a larger set of values; no number of attempts is the last.
WIDEN_EVERY = 4

#: Titles by the gender they tell, and given names by gender and script.
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Monsieur", "Sir", "г-н", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Mademoiselle", "г-жа", "госпожа"],
    "n": ["Dr", "Prof", "Professor"],
}
GIVEN = {
    "latin": {
        "m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul Robert Simon Tomas Victor",
        "f": "Ada Berta Clara Diana Emma Flora Greta Hanna Irene Julia Karla Lena Maria Nora Olivia Paula Rosa Sara Tina Vera",
        "n": "Alex Ariel Billie Charlie Dana Eden Frankie Gray Harper Indigo Jamie Kim Lee Morgan Noa Parker Quinn Robin Sam Toni",
    },
    "cyrillic": {
        "m": "Адам Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Степан",
        "f": "Анна Белла Вера Галина Дарья Елена Ирина Карина Лидия Мария Нина Ольга Полина Роза София",
        "n": "Женя Саша Валя Шура Слава",
    },
}
#: Common given names by gender that tell a person without a title (with those of GIVEN in Latin script).
COMMON = {
    "m": "James John William Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Donald Steven Andrew Joshua Kenneth Kevin Brian George "
         "Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Frank "
         "Hans Peter Klaus Jürgen Wolfgang Stefan Pierre Jean Michel Philippe José Juan Antonio Manuel Michael",
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Sandra Margaret Ashley Kimberly Emily Donna Michelle "
         "Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Kathleen Amy Angela Shirley Anna Brenda Pamela Nicole Samantha Katherine Christine "
         "Ursula Monika Petra Sabine Marie Sophie Isabelle Carmen Ana Helen",
}
_EDGE = r"(?<![\p{L}\p{N}_])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|\d{1,2})"
_ALL_TITLES = "|".join(sorted((t for v in TITLES.values() for t in v), key=len, reverse=True))
_NAMES = "|".join(sorted({n for names in [*COMMON.values(), *(GIVEN["latin"][g] for g in "mf")] for n in names.split()}, key=lambda n: (-len(n), n)))
_BLANKS = r"[\x20\t]{0,3}"
_PEM = r"-----{} [A-Z0-9 ]{{0,40}}PRIVATE KEY-----"
_BORN = rf"(?i:date of birth|born(?:[ ]on)?|dob|geboren(?:[ ]am)?|née?[ ]le|nacid[oa](?:[ ]el)?){_BLANKS}:?{_BLANKS}"
_LABEL = rf"(?i:passport|reisepass|passeport|pasaporte)[ ]?(?i:number|no\.?|nr\.?|#)?{_BLANKS}[:=]?{_BLANKS}"
_STREET = (r"[ ](?:Street|Avenue|Road|Lane|Boulevard|Drive|Court|Square|St|Ave|Rd|Ln|Blvd)", r"(?:straße|strasse|weg|platz|gasse|allee)[ ]\d{1,4}[a-z]?")
#: The detection patterns, tried in this order at each place.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8}",
    "assigned": r"(?i:password|passwd|secret|token|api[_\-]?key|access[_\-]?key)[\x20\t]{0,3}[=:][\x20\t]{0,3}[\"']?[A-Za-z0-9_\-+/=.~!@#$%^&*]{8,}+",
    "pem": _PEM.format("BEGIN") + r"[A-Za-z0-9+/=\s:,.\-]*?" + _PEM.format("END"),
    "secret": r"(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9_\-]{20,}|eyJ[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]{8,}+\.[A-Za-z0-9_\-]*+|[0-9a-fA-F]{32,}+)(?![\p{L}\p{N}_])",
    "passport": _LABEL + r"[A-Z]{0,2}\d{6,9}(?![\p{L}\d])",
    "birth": _BORN + r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./\-]\d{1,2}[./\-]\d{4})(?![\p{L}\d])",
    "ipv6": r"(?=[0-9a-fA-F:]*\d)(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\p{L}\d:])",
    "ipv4": rf"(?<![Vv]ersion[ ])(?<![Rr]elease[ ])(?<![Vv]er\.?[ ])(?<![Vv]\.?[ ]){_OCTET}(?:\.{_OCTET}){{3}}(?![.\d]*\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?![\d\-])",
    "iban": r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){3,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "address": rf"(?:\d{{1,5}}[ ]\p{{Lu}}\p{{L}}+(?:[ ]\p{{Lu}}\p{{L}}+)??{_STREET[0]}|\p{{Lu}}\p{{L}}+?{_STREET[1]})(?!\p{{L}})",
    "phone": r"(?:\+\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,5}|\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}|0\d{2,4}[ /\-]\d{5,8}|[2-9]\d{9})(?![\p{L}\d])",
    "card": r"\d(?:[ \-]?\d){12,18}(?![\p{L}\d])",
    "person": rf"(?:(?:{_ALL_TITLES})\.?|(?=\p{{Lu}}\p{{L}}+[ ]\p{{Lu}})(?:{_NAMES}))[ ]\p{{Lu}}\p{{L}}+(?:[ \-]\p{{Lu}}\p{{L}}+){{0,2}}",
}
#: The name of an assignment may follow '_' (access_token=): the part before it stays.
ENTITY = rf"(?<![\p{{L}}\p{{N}}_.%+\-@])(?:{PATTERNS['email']})|(?<![\p{{L}}\p{{N}}])(?:{PATTERNS['assigned']})|{_EDGE}(?:" + "|".join(p for k, p in PATTERNS.items() if k not in ("email", "assigned", "phone")) + rf")|(?<![\p{{L}}\p{{N}}_+(])(?:{PATTERNS['phone']})"

_TITLE = rf"^(?:{_ALL_TITLES})\.?[ ]"
#: What stands before the identifying part of a labelled value, and behind it.
_BEFORE = {"assigned": r"^[A-Za-z_\-]+[\x20\t]*[=:][\x20\t]*[\"']?", "pem": "^" + _PEM.format("BEGIN"), "passport": "^" + _LABEL, "birth": "^" + _BORN, "person": _TITLE}
_AFTER = {"pem": _PEM.format("END") + "$", "address": f"(?:{'|'.join(_STREET)})$"}


def _is_card(m: Column) -> Column:
    """16 digits, or a valid check digit and no book number."""
    digits = F.regexp_replace(m, F.lit(r"\D"), F.lit(""))
    return (F.length(digits) == 16) | ((_luhn(m) % 10 == 0) & ~digits.rlike(r"^97[89]\d{10}$"))


def _kind(m: Column) -> Column:
    """The type of a found string; whole-match tests in the order of PATTERNS. A digit
    run that is no card is `keep`."""
    out = None
    for name, p in PATTERNS.items():
        test = m.rlike(f"^(?:{p})$")
        kind = F.when(_is_card(m), F.lit(name)).otherwise(F.lit("keep")) if name == "card" else F.lit(name)
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("secret")


def _edge_part(kind: Column, m: Column, patterns: dict[str, str]) -> Column:
    """The label before or behind the identifying part, '' without one."""
    out = None
    for name, p in patterns.items():
        part = F.regexp_extract(m, p, 0)
        out = F.when(kind == name, part) if out is None else out.when(kind == name, part)
    return out.otherwise(F.lit(""))


def _value(kind: Column, m: Column) -> Column:
    """The identifying part: without a title, a label or the type of a street."""
    before, after = F.length(_edge_part(kind, m, _BEFORE)), F.length(_edge_part(kind, m, _AFTER))
    return F.when(kind.isin(*_BEFORE, *_AFTER), F.substr(m, before + 1, F.length(m) - before - after)).otherwise(m)


def _norm(kind: Column, value: Column) -> Column:
    return (
        F.when(kind.isin("phone", "card", "ssn", "birth"), F.regexp_replace(value, F.lit(r"\D"), F.lit("")))
        .when(kind == "iban", F.regexp_replace(value, F.lit(" "), F.lit("")))
        .when(kind == "pem", F.regexp_replace(value, F.lit(r"\s"), F.lit("")))
        .when(kind.isin("email", "person", "ipv6", "address"), F.lower(value)).otherwise(value)
    )


def _family(kind: Column) -> Column:
    """Types whose values must be told apart from each other: an assigned value or a key is a secret."""
    return F.when(kind.isin("assigned", "pem"), F.lit("secret")).otherwise(kind)


def _pick(seed: Column, at: Column | int, letters: str) -> Column:
    n = F.pmod(F.xxhash64(seed, F.lit(at) if isinstance(at, int) else at), F.lit(len(letters))).cast("int")
    return F.substr(F.lit(letters), n + 1, F.lit(1))


def _redraw(value: Column, seed: Column, hexadecimal: Column) -> Column:
    """Letters and digits drawn anew by position among letters and digits; the rest stays."""
    def new(c: Column, i: Column) -> Column:
        lower = F.when(hexadecimal, _pick(seed, i, "abcdef")).otherwise(_pick(seed, i, "abcdefghijklmnopqrstuvwxyz"))
        return F.when(c.rlike("[0-9]"), _pick(seed, i, "0123456789")).when(c.rlike("[a-z]"), lower).otherwise(F.upper(lower))

    # Linear in the length: what lies between letters and digits is joined back in one step.
    drawn = F.transform(F.regexp_extract_all(value, F.lit("[A-Za-z0-9]"), F.lit(0)), new)
    between = F.split(value, "[A-Za-z0-9]", -1)
    return F.array_join(F.zip_with(F.concat(F.array(F.lit("")), drawn), between, lambda d, b: F.concat(d, b)), "")


def _luhn(value: Column) -> Column:
    """The Luhn sum of the digits of a string."""
    digits = F.split(F.reverse(F.regexp_replace(value, F.lit(r"\D"), F.lit(""))), "")
    number = F.transform(digits, lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    each = F.transform(number, lambda d, i: F.when(i % 2 == 0, d).otherwise((d * 2) % 10 + F.when(d >= 5, 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def _card(value: Column, drawn: Column) -> Column:
    last = F.substr(drawn, F.length(drawn), F.lit(1)).try_cast("int")
    fixed = F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), ((last + 10 - _luhn(drawn) % 10) % 10).cast("string"))
    return F.when(_luhn(value) % 10 == 0, fixed).otherwise(drawn)


def _tier(attempt: Column) -> Column:
    return F.floor(attempt / WIDEN_EVERY).cast("int")


def _ipv4(value: Column, seed: Column, tier: Column) -> Column:
    """Private addresses keep their first half, then (by tier) move within 10/8 or 127/8;
    then all use the reserved 240/4, then more than four parts."""
    part = F.split(value, r"\.")
    own = value.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.")
    drawn = F.transform(part, lambda p, i: F.when(own & (i < 2), p).otherwise((F.pmod(F.xxhash64(seed, i), F.when(i == 0, 223).otherwise(254)) + 1).cast("string")))
    # A public address must not become a private one.
    head = F.when(~own & drawn[0].isin("10", "127", "172", "192"), F.lit("198")).otherwise(drawn[0])
    octet = lambda i: F.pmod(F.xxhash64(seed, i), F.lit(256)).cast("string")
    rest = F.concat_ws(".", *[octet(F.lit(i)) for i in (1, 2, 3)])
    block = F.when(value.startswith("127."), F.lit("127.")).otherwise(F.lit("10."))
    reserved = F.concat((F.pmod(F.xxhash64(seed, F.lit(0)), F.lit(16)) + 240).cast("string"), F.lit("."), rest)
    more = F.concat(reserved, F.lit("."), F.array_join(F.transform(F.sequence(F.lit(4), F.greatest(tier, F.lit(3)) + 1), octet), "."))
    plain = F.concat_ws(".", head, drawn[1], drawn[2], drawn[3])
    return F.when((tier == 0) | (~own & (tier == 1)), plain).when(tier == 1, F.concat(block, rest)).when(tier == 2, reserved).otherwise(more)


def _birth(value: Column, seed: Column, tier: Column) -> Column:
    """A real date of the same form; by tier from a longer span of years."""
    parts, mark = F.split(value, r"[./\-]"), F.regexp_extract(value, r"[./\-]", 0)
    year = F.lpad((1900 + F.pmod(F.xxhash64(seed, F.lit(0)), F.least(F.lit(8000), 120 + tier * 1000))).cast("string"), 4, "0")
    # Up to 12 is a day and a month in any order.
    part = lambda i, at: F.lpad((F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(12)) + 1).cast("string"), F.greatest(F.length(parts[at]), F.lit(2)), F.lit("0"))
    return F.when(F.length(parts[0]) == 4, F.concat_ws("-", year, part(1, 1), part(2, 2))).otherwise(F.concat(part(1, 0), mark, part(2, 1), mark, year))


def _email(value: Column, seed: Column, tier: Column, key: str) -> Column:
    """A redrawn local part at a reserved domain; one domain gets one surrogate domain."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    label = F.split(domain, r"\.")
    top = F.element_at(label, -1)
    rest = F.when(F.size(label) > 2, F.array_join(F.slice(label, 1, F.greatest(F.size(label) - 2, F.lit(0))), ".")).otherwise(label[0])
    seed_domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), F.lower(domain)), 256)
    tail = F.when(F.size(label) > 2, F.concat(F.lit(".example."), top)).otherwise(F.lit(".example"))
    return F.concat(_redraw(F.concat(local, F.repeat(F.lit("0"), tier)), seed, F.lit(False)), F.lit("@"), _redraw(rest, seed_domain, F.lit(False)), tail)


def _person(match: Column, value: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Names of the same gender and script: given names from the lists, surnames of
    drawn syllables; one surname gets one surrogate unless a draw is repeated. From
    tier 1 on each person has an own surname, longer by a syllable a tier."""
    tier = _tier(attempt)
    title = F.regexp_replace(F.regexp_extract(match, _TITLE, 0), F.lit(r"[. ]"), F.lit(""))
    lists = {g: [n.lower() for names in (COMMON.get(g, ""), *(by[g] for by in GIVEN.values())) for n in names.split()] for g in "mf"}
    words = F.split(value, r"[ \-]")
    low = F.lower(words[0])
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").when(low.isin(*lists["m"]), "m").when(low.isin(*lists["f"]), "f").otherwise("n")
    cyrillic = value.rlike(r"\p{IsCyrillic}")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("person"), norm, attempt.cast("string")), 256)
    seed_last = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("surname"), F.lower(F.element_at(words, -1)), attempt.cast("string")), 256)
    seed_last = F.when(tier > 0, seed).otherwise(seed_last)

    def given(i: Column) -> Column:
        out = None
        for script, by in GIVEN.items():
            for g, names in by.items():
                test = (cyrillic if script == "cyrillic" else ~cyrillic) & (gender == g)
                names = names.split()
                one = F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(F.xxhash64(seed, i), F.lit(len(names))) + 1).cast("int"))
                out = F.when(test, one) if out is None else out.when(test, one)
        return out

    def drawn(consonants: str, vowels: str) -> Column:
        more = F.transform(F.sequence(F.lit(1), F.greatest(tier, F.lit(1))), lambda t: F.concat(_pick(seed_last, t * 2 + 6, consonants), _pick(seed_last, t * 2 + 7, vowels)))
        return F.concat(*[_pick(seed_last, i, consonants if i % 2 == 0 else vowels) for i in range(8)], F.when(tier > 0, F.array_join(more, "")).otherwise(F.lit("")))

    last = F.initcap(F.when(cyrillic, F.concat(drawn("бвгдклмнпрст", "аеиоу"), F.when(gender == "f", F.lit("ва")).otherwise(F.lit("в")))).otherwise(drawn("bdfgklmnprstvz", "aeiou")))
    new = F.transform(words, lambda w, i: F.when(i == F.size(words) - 1, last).otherwise(given(i)))
    cased = F.zip_with(words, new, lambda w, n: F.when((F.length(w) > 1) & (w == F.upper(w)), F.upper(n)).otherwise(n))
    return F.when(value.contains("-"), F.array_join(cased, "-")).otherwise(F.array_join(cased, " "))


def _seed(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), _family(kind), norm, attempt.cast("string")), 256)


def _hexadecimal(value: Column) -> Column:
    return value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")


def _surrogate(kind: Column, match: Column, value: Column, norm: Column, attempt: Column, seed: Column, drawn: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^(?:\+\d{1,3}(?=[ .\-(])|0)", 0)
    before, after = _edge_part(kind, match, _BEFORE), _edge_part(kind, match, _AFTER)
    new = (
        F.when(kind == "email", _email(value, seed, _tier(attempt), key)).when(kind == "ipv4", _ipv4(value, seed, _tier(attempt))).when(kind == "card", _card(value, drawn))
        .when(kind == "phone", F.concat(country, F.substr(drawn, F.length(country) + 1, F.length(drawn))))
        .when(kind == "ssn", F.concat(F.lit("9"), F.substr(drawn, F.lit(2), F.length(drawn))))
        .when(kind == "iban", F.concat(F.substr(value, F.lit(1), F.lit(2)), F.substr(drawn, F.lit(3), F.length(drawn))))
        .when(kind == "birth", _birth(value, seed, _tier(attempt)))
        .when(kind == "person", _person(match, value, norm, attempt, key)).otherwise(drawn)
    )
    # The house number behind a street's name is drawn with it.
    tail = F.when(kind == "address", F.concat(F.regexp_replace(after, F.lit(r"\d+[a-z]?$"), F.lit("")), _redraw(F.regexp_extract(after, r"\d+[a-z]?$", 0), seed, F.lit(False)))).otherwise(after)
    return F.when(kind == "keep", match).otherwise(F.concat(before, new, tail))


def surrogates(matches: Column, attempt_of, key: str, mentions: Column | None = None) -> Column:
    """What replaces each string of an array of found strings. Each transform binds
    one derived part, so that the next ones refer to it instead of repeating it. A
    string among `mentions` (struct of mention, person) gets that person's surrogate
    without the title, or its surname."""
    def person(m: Column) -> Column:
        return m if mentions is None else F.coalesce(F.get(F.filter(mentions, lambda x: x["mention"] == m), F.lit(0))["person"], m)

    def bind(x: Column, names: list[str], name: str, derive) -> Column:
        """The names bound so far, and one more."""
        return F.transform(x, lambda e: F.struct(*[e[c].alias(c) for c in names], derive(e).alias(name)))

    x, names = F.transform(matches, lambda m: F.struct(m.alias("found"), person(m).alias("match"))), ["found", "match"]
    for name, derive in (
        ("kind", lambda e: _kind(e["match"])), ("attempt", lambda e: attempt_of(e["match"])), ("value", lambda e: _value(e["kind"], e["match"])),
        ("norm", lambda e: _norm(e["kind"], e["value"])), ("seed", lambda e: _seed(e["kind"], e["norm"], e["attempt"], key)),
        ("drawn", lambda e: _redraw(F.concat(e["value"], F.repeat(F.lit("0"), _tier(e["attempt"]))), e["seed"], _hexadecimal(e["value"]) | (e["kind"] == "ipv6"))),
    ):
        x = bind(x, names, name, derive)
        names = [*names, name]
    x = F.transform(x, lambda e: F.struct(e["found"].alias("found"), e["match"].alias("match"), e["value"].alias("value"),
                                          _surrogate(e["kind"], e["match"], e["value"], e["norm"], e["attempt"], e["seed"], e["drawn"], key).alias("new")))

    def shown(e: Column) -> Column:
        name = F.regexp_replace(e["new"], F.lit(_TITLE), F.lit(""))
        return F.when(e["found"] == e["match"], e["new"]).when(e["found"] == e["value"], name).otherwise(F.element_at(F.split(name, r"[ \-]"), -1))

    return F.transform(x, shown)


def found(text: Column) -> Column:
    """All entity strings of a whole text, in order, without later mentions of persons."""
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def with_found(rows: DataFrame, text_col: str) -> DataFrame:
    """Adds `__mentions` (how a text may name its persons again, and whom that means; the
    first person of a surname), `__pattern` (of entities and mentions; null without
    mentions) and `__found`, all entity strings of the text in order."""
    rows = rows.withColumn("__base", found(F.col(text_col)))
    persons = F.filter(F.array_distinct("__base"), lambda m: m.rlike(f"^(?:{PATTERNS['person']})$"))
    name = lambda m: F.regexp_replace(m, F.lit(_TITLE), F.lit(""))
    again = lambda m, mention: F.struct(mention.alias("mention"), m.alias("person"))
    every = F.flatten(F.transform(persons, lambda m: F.array(again(m, name(m)), again(m, F.element_at(F.split(name(m), r"[ \-]"), -1)))))
    rows = rows.withColumn("__every", F.filter(every, lambda x: F.length(x["mention"]) > 2))
    first = F.filter("__every", lambda x, i: F.array_position(F.transform("__every", lambda y: y["mention"]), x["mention"]) == i + 1)
    rows = rows.withColumn("__mentions", F.when(F.size("__base") > 0, first).otherwise(F.slice("__every", 1, 0)))
    longest = F.array_sort(F.transform("__mentions", lambda x: x["mention"]), lambda a, b: F.length(b) - F.length(a))
    pattern = F.concat(F.lit(f"{ENTITY}|{_EDGE}(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    rows = rows.withColumn("__pattern", F.when(F.size("__mentions") > 0, pattern))
    whole = F.when(F.col("__pattern").isNull(), F.col("__base")).otherwise(F.regexp_extract_all(F.col(text_col), F.col("__pattern"), F.lit(0)))
    return rows.withColumn("__found", whole).drop("__every", "__base")


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (family, norm) over all texts, with one written form for the check."""
    one = docs.select(F.explode(found(F.col(text_col))).alias("match")).groupBy("match").count().withColumn("kind", _kind(F.col("match"))).where("kind <> 'keep'")
    return one.groupBy(_family(F.col("kind")).alias("family"), _norm(F.col("kind"), _value(F.col("kind"), F.col("match"))).alias("norm")).agg(
        F.min(F.struct("match", "kind")).alias("form")).select("family", "norm", "form.match", "form.kind")


def collision_free(known: DataFrame, key: str) -> DataFrame:
    """(family, norm, attempt) of the entities that need an attempt above zero.

    Of entities that draw the same value the smallest keeps it, unless the value is
    a real entity. Only the others draw again; their draws are tested against the
    real entities, the values settled so far and each other.
    """
    spark = known.sparkSession
    base = scratch_path(spark, "surrogates")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    def draw(df: DataFrame) -> DataFrame:
        new = surrogates(F.array("match"), lambda _: F.col("attempt"), key)
        return df.withColumn("new", F.element_at(new, 1)).withColumn("drawn", _norm(F.col("kind"), _value(F.col("kind"), F.col("new")))).drop("new")

    def judged(drawn: DataFrame, taken: list[DataFrame]) -> DataFrame:
        """`drawn` with `again`: the value is another's."""
        keeper = drawn.groupBy("family", "drawn").agg(F.min("norm").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        out = drawn.join(keeper, ["family", "drawn"], "left").withColumn("again", F.coalesce(F.col("keeper") != F.col("norm"), F.lit(False))).drop("keeper")
        for t in taken:
            out = out.join(t.select("family", "drawn", F.lit(True).alias("hit")), ["family", "drawn"], "left").withColumn("again", F.col("again") | F.col("hit").isNotNull()).drop("hit")
        return out

    known = stored(known, "known")
    real = known.select("family", F.col("norm").alias("drawn"))
    first = stored(judged(stored(draw(known.withColumn("attempt", F.lit(0))), "drawn-0"), [real]), "0")
    settled, late, moving, number = first.where(~F.col("again")), None, first.where("again"), 0
    while not moving.isEmpty():  # ends: the values to draw from grow with the attempts, the entities do not
        number += 1
        drawn = stored(draw(moving.select("family", "norm", "match", "kind", (F.col("attempt") + 1).alias("attempt"))), f"drawn-{number}")
        round_ = stored(judged(drawn, [real, settled] + [late] * (late is not None)), str(number))
        calm, moving = round_.where(~F.col("again")), round_.where("again")
        late = calm if late is None else late.unionByName(calm)
    none = spark.createDataFrame([], "family string, norm string, attempt int")
    return none if late is None else late.select("family", "norm", "attempt")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_entities") -> DataFrame:
    """`docs` with every entity of `text_col` replaced and a column `count_col` with
    their number (a column of that name is replaced). `key` is a secret of the
    caller: with it, and only with it, surrogates can be told again.

    A null text stays null with 0 entities; a text without entities is unchanged.
    Rows are neither added nor lost, repeated rows and nulls elsewhere need no
    special case, an empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c != count_col]
    retry = collision_free(entities(docs, text_col), key)
    rows = with_found(docs.select(*columns), text_col)
    if retry.isEmpty():
        return _rewrite(rows, columns, text_col, key, count_col, F.lit(None).cast("map<string,int>"))
    # Texts that hold a redrawn entity, by content hash; copies share one entry.
    mark = F.sha2(F.col(text_col), 256)
    held = (
        docs.select(found(F.col(text_col)).alias("__found"), F.col(text_col)).where(F.size("__found") > 0).select(mark.alias("__mark"), F.explode("__found").alias("match")).distinct()
        .withColumn("kind", _kind(F.col("match"))).withColumn("family", _family(F.col("kind"))).withColumn("norm", _norm(F.col("kind"), _value(F.col("kind"), F.col("match"))))
        .join(retry, ["family", "norm"]).groupBy("__mark").agg(F.map_from_entries(F.collect_set(F.struct("match", "attempt"))).alias("__attempts"))
    )
    # Rows without an entity have no partner: they are dealt evenly.
    joined = rows.withColumn("__mark", F.when(F.size("__found") > 0, mark).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))))
    joined = joined.join(held, "__mark", "left")
    return _rewrite(joined, columns, text_col, key, count_col, F.col("__attempts"))


def _rewrite(rows: DataFrame, columns: list[str], text_col: str, key: str, count_col: str, attempts: Column) -> DataFrame:
    parts = F.when(F.col("__pattern").isNull(), F.split(F.col(text_col), ENTITY, -1)).otherwise(F.split(F.col(text_col), F.col("__pattern"), -1))
    new = surrogates(F.col("__found"), lambda m: F.coalesce(F.try_element_at(attempts, m), F.lit(0)), key, F.col("__mentions"))
    # Few texts hold an entity; the others are neither split nor drawn for.
    some = F.size("__found") > 0
    rows = rows.withColumn("__parts", F.when(some, parts)).withColumn("__new", F.when(some, new))
    text = F.concat(F.array_join(F.zip_with(F.slice("__parts", 1, F.size("__found")), F.col("__new"), lambda p, s: F.concat(p, s)), ""), F.element_at("__parts", -1))
    out = F.when(F.size("__found") > 0, text).otherwise(F.col(text_col))
    # A string that stays as it is was none.
    changed = F.size(F.filter(F.zip_with("__found", "__new", lambda a, b: a == b), lambda same: ~same))
    count = F.when(F.size("__found") > 0, changed).otherwise(0).cast("int")
    return rows.select(*[out.alias(c) if c == text_col else F.col(c) for c in columns], count.alias(count_col))
