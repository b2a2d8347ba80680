"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Numbers and dates that pass their checks are permuted within their format by a keyed Feistel
network, so equal values stay linked across documents and the result is a valid value again:

- card numbers (13 to 19 digits, Luhn): all digits but the last are permuted, the check digit follows;
- account numbers (two letters, two check digits, mod 97): digits permuted, check digits follow;
- social security numbers, telephone numbers (the country code stays; 8 to 15 digits after a plus, or
  North American groups), IPv4 and IPv6 addresses (the latter come out in full, networks stay linked);
- dates from 1700 to 2099, permuted over the 146,097 days of four centuries.

E-mail addresses, secrets and private key blocks have no such format; they get keyed hashes of the same
shape, which link equal values as well. Numbers that fail their checks and all other text stay as they
are. An international number takes digit groups up to the sixth that follow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
#: Session setting that holds the key. Whoever has it can undo the permutations, so there is no default.
KEY_SETTING = "spark.qualmart.pseudonymKey"

_ALONE = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Letters and digits of e-mail addresses: ASCII and accented Latin letters.
_LATIN = "A-Za-z0-9À-ÖØ-öø-ɏ"
#: Alternatives in the order in which they are tried at a place.
PATTERNS = {
    "email": rf"(?<![{_LATIN}._%+\-])[{_LATIN}._%+\-]++@[{_LATIN}\-]{{1,63}}(?:\.[{_LATIN}\-]{{1,63}}){{1,8}}",
    "secret": r"(?i:token|secret|api[_\-]?key)[ \t]?[=:][ \t]?\"?[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])"
              r"|(?i:password|passwd|pwd)[ \t]?[=:][ \t]?\"?[^\s\"'<>|]{4,128}"
              r"|(?<![0-9A-Za-z])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])"
              r"|(?i:token|secret|api[_\-]?key)[ \t]?[=:][ \t]?\"?(?=[A-Za-z_\-]*\d)[0-9A-Za-z_\-]{16,}+"
              r"|(?<![0-9A-Za-z_])gh[pousr]_[0-9A-Za-z]{36,}+|(?<![0-9A-Za-z])xox[abprs]-[0-9A-Za-z\-]{10,}+"
              r"|(?<![0-9A-Za-z])AIza[0-9A-Za-z_\-]{35}(?![0-9A-Za-z_\-])"
              r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[^\-]{1,20000}-----END [A-Z ]{0,20}PRIVATE KEY-----",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\) ?|(?<![\d\-])\d{3}[.\-])\d{3}[.\-]\d{4}(?![0-9A-Za-z\-])"
             r"|(?<![0-9A-Za-z+])\+[1-9]\d{0,2}(?:[ .\-/]?\(?\d{1,5}\)?){2,6}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z\-])\d{3}-\d{2}-\d{4}(?![0-9A-Za-z\-])",
    "date": r"(?<![0-9A-Za-z.])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?[0-9A-Za-z])"
          r"|(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:]|\.\d)",
    "card": r"(?<![0-9A-Za-z])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5})(?![0-9A-Za-z])",
}
KINDS = tuple(PATTERNS)
#: All that may be an account number at each place, as far as it can reach.
_ACCOUNTS = rf"{_ALONE[0]}(?=({PATTERNS['iban'].removeprefix(_ALONE[0])}))"
#: Characters of an account number by country, without spaces.
_LENGTHS = {int(n): set(c.split()) for n, c in (x.split(": ") for x in (
    "15: NO", "16: BE", "18: DK FI FO GL NL SD", "19: MK SI", "20: AT BA EE KZ LT LU MN XK", "21: CH HR LI LV",
    "22: BG BH CR DE GB GE IE ME RS VA", "23: AE GI IL IQ OM SO TL", "24: AD CZ ES MD PK RO SA SE SK TN VG",
    "25: LY PT ST", "26: IS TR", "27: BI DJ FR GR IT MC MR SM", "28: AL AZ BY CY DO GT HU LB NI PL SV",
    "29: BR EG PS QA UA", "30: JO KW MU YE", "31: MT SC", "32: LC", "33: RU"))}
#: Any text with personal data of these kinds has one of these.
_HINT = r"[0-9@]|AKIA|ASIA|gh[pousr]_|xox[abprs]-|AIza|PRIVATE KEY|(?i:pwd|passw|token|secret|api[_\-]?key)"

_EPOCH, _DAYS = "1700-01-01", (189, 773)  # 189 x 773 = 146,097 days: 1700 to 2099
_FORMATS = tuple((where, form) for where, forms in (
    (r"^\d{4}-", ("yyyy-MM-dd",)), (r"^\d{4}/", ("yyyy/MM/dd",)),
    (r"/\d{4}$", ("MM/dd/yyyy", "dd/MM/yyyy", "M/d/yyyy", "d/M/yyyy")),
    (r"\.", ("dd.MM.yyyy", "d.M.yyyy"))) for form in forms)
#: A telephone number's country code: up to a separator, or else by the length that its first digits give.
_COUNTRY = (r"^\+\d{1,3}(?=[ .\-/(])|^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
            r"|\d{3})")


def session_key(spark: SparkSession, otherwise: str) -> str:
    """The session's key; ``otherwise`` is for data made up for tests."""
    return spark.conf.get(KEY_SETTING, otherwise)


def _prf(key: str, tag: Column, round_: Column, value: Column) -> Column:
    """Keyed pseudo-random number below 2^60."""
    text = F.concat_ws("|", F.lit(key), tag, round_.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, m_left: Column, m_right: Column, tag: Column, key: str) -> Column:
    """Struct (l, r): a keyed permutation of the pairs below (m_left, m_right). Each round adds a
    keyed function of one half to the other; every round can be undone, whatever the function."""
    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(s.l + F.pmod(_prf(key, tag, i, s.r), m_left), m_left)).otherwise(s.l).alias("l"),
            F.when(odd, s.r).otherwise(F.pmod(s.r + F.pmod(_prf(key, tag, i, s.l), m_right), m_right)).alias("r"))
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _let(value: Column, use) -> Column:
    """``use`` of the value, computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted_digits(digits: Column, tag: str, key: str) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 36."""
    def with_digits(d: Column) -> Column:
        n = F.length(d)
        half = F.floor(n / 2).cast("int")
        power = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
        out = feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, n - half), power(half),
                      power(n - half), F.concat(F.lit(tag), n.cast("string")), key)
        return _let(out, lambda s: F.concat(F.lpad(s.l.cast("string"), half, "0"),
                                            F.lpad(s.r.cast("string"), n - half, "0")))
    return _let(digits, with_digits)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        return F.struct(F.concat(s.out, F.when(digit, F.substring(digits, s.k, F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, s.k + 1).otherwise(s.k).alias("k"))
    return F.aggregate(F.split(shape, ""), start, step, lambda s: s.out)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits in front of a check digit that isn't there (the last one is doubled)."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def _check_digit(payload: Column) -> Column:
    return ((F.lit(10) - luhn_sum(payload) % 10) % 10).cast("string")


def _front(digits: Column) -> Column:
    return F.substring(digits, F.lit(1), F.length(digits) - 1)


def _is_card(m: Column) -> Column:
    return _let(_digits(m), lambda d: (F.substring(d, -1, 1) == _check_digit(_front(d))) & ~d.rlike(r"^(\d)\1*$"))


def _card(m: Column, key: str) -> Column:
    payload = permuted_digits(_front(_digits(m)), "card", key)
    return _let(payload, lambda p: _refill(m, F.concat(p, _check_digit(p))))


def mod97(text: Column) -> Column:
    """Remainder by 97 of a string of digits and capital letters (A is 10)."""
    def step(a: Column, c: Column) -> Column:
        letter = c.rlike("^[A-Z]$")
        return F.when(letter, (a * 100 + F.ascii(c) - 55) % 97).otherwise((a * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _is_iban(m: Column) -> Column:
    return _let(F.replace(m, F.lit(" "), F.lit("")), lambda t: F.when(
        F.length(_digits(t)) >= 6, mod97(F.concat(F.substring(t, F.lit(5), F.length(t)), F.substring(t, 1, 4))) == 1)
        .otherwise(False))


def _accounts(text: Column) -> Column:
    """The account numbers of a text: at each place where one may begin, the reading that passes the
    check and ends at a border of the blocks; of several the one of its country's length, else the
    longest."""
    def reading(longest: Column) -> Column:
        parts = F.split(longest, " ")
        prefixes = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(
            F.slice(parts, F.lit(1), n), " "))
        valid = F.filter(prefixes, lambda p: F.when(p.rlike(f"^(?:{PATTERNS['iban']})$"), _is_iban(p)).otherwise(False))
        of_country = F.create_map(*[F.lit(x) for n, countries in _LENGTHS.items() for c in sorted(countries) for x in (c, n)])
        usual = F.filter(valid, lambda p: F.length(F.replace(p, F.lit(" "), F.lit(""))) == F.try_element_at(
            of_country, F.substring(p, 1, 2)))
        return F.coalesce(F.get(usual, F.lit(0)), F.get(valid, F.lit(0)))
    found = F.transform(F.regexp_extract_all(text, F.lit(_ACCOUNTS), F.lit(1)), reading)
    return F.array_distinct(F.filter(found, lambda a: a.isNotNull()))


def _pattern(accounts: Column) -> Column:
    """The pattern of all kinds, with these account numbers in place of all that look like one: what
    fails its check is not consumed, and other kinds are found in it."""
    order = list(PATTERNS)
    at = order.index("iban")
    before, behind = ("|".join(PATTERNS[k] for k in ks) for ks in (order[:at], order[at + 1:]))
    return F.when(F.size(accounts) > 0, F.concat(
        F.lit(f"{before}|{_ALONE[0]}(?:"), F.array_join(F.reverse(F.array_sort(accounts)), "|"),
        F.lit(f"){_ALONE[1]}|{behind}"))).otherwise(F.lit(f"{before}|{behind}"))


def _iban(m: Column, key: str) -> Column:
    body = F.substring(m, F.lit(5), F.length(m))
    return _let(_refill(body, permuted_digits(_digits(body), "iban", key)), lambda b: F.concat(
        F.substring(m, 1, 2),
        F.lpad((F.lit(98) - mod97(F.concat(F.replace(b, F.lit(" "), F.lit("")), F.substring(m, 1, 2), F.lit("00"))))
               .cast("string"), 2, "0"), b))


def _is_phone(m: Column) -> Column:
    return ~m.startswith("+") | F.length(_digits(m)).between(8, 15)


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, _COUNTRY, 0)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return F.concat(country, _refill(rest, permuted_digits(_digits(rest), "phone", key)))


def _is_ssn(m: Column) -> Column:
    return ~m.rlike(r"^(?:000|666|9)|-00-|-0000$")


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666 (898), groups 01 to 99, serials 0001 to 9999, as one pair."""
    part = lambda at, n: F.substring(m, at, n).cast("long")
    area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)
    new = feistel(area * 99 + part(5, 2) - 1, part(8, 4) - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)

    def text(s: Column) -> Column:
        a = F.floor(s.l / 99)
        a = a + F.when(a >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((s.l % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((s.r + 1).cast("string"), 4, "0"))
    return _let(new, text)


def _ip_parts(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda x: x.cast("int"))


def _is_ip(m: Column) -> Column:
    halves = F.split(m, "::")
    groups = F.size(F.filter(F.split(m, ":"), lambda g: g != ""))
    v6 = ~m.rlike("^:(?!:)|(?<!:):$|:::") & F.when(F.size(halves) == 1, groups == 8).otherwise(
        (F.size(halves) == 2) & (groups <= 7))
    return F.when(m.contains(":"), v6).otherwise(F.forall(_ip_parts(m), lambda x: x <= 255))


def _ip6(m: Column, key: str) -> Column:
    """The network's and the host's 64 bits are permuted apart, the host's by a key of its network."""
    def full(half: Column) -> Column:
        return F.transform(F.filter(F.split(half, ":"), lambda g: g != ""), lambda g: F.lpad(F.lower(g), 4, "0"))

    def of(halves: Column) -> Column:
        front, back = full(halves[0]), full(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        zeros = F.array_repeat(F.lit("0000"), F.lit(8) - F.size(front) - F.size(back))
        return F.array_join(F.concat(front, zeros, back), "")
    size = F.lit(1 << 32)
    word = lambda h, k: F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long")
    text = lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")
    joined = lambda s: F.concat(text(s.l), text(s.r))

    def new(h: Column) -> Column:
        net = joined(feistel(word(h, 0), word(h, 1), size, size, F.lit("ip6"), key))
        host = joined(feistel(word(h, 2), word(h, 3), size, size, F.concat(F.lit("ip6"), F.substring(h, 1, 16)), key))
        return F.concat_ws(":", F.regexp_extract_all(F.concat(net, host), F.lit("[0-9a-f]{4}"), F.lit(0)))
    return _let(_let(F.split(m, "::"), of), new)


def _ip(m: Column, key: str) -> Column:
    size = F.lit(65536)

    def of(p: Column) -> Column:
        return _let(feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], size, size, F.lit("ip"), key),
                    lambda s: F.concat_ws(".", *[x.cast("string") for x in (
                        F.shiftright(s.l, 8), s.l % 256, F.shiftright(s.r, 8), s.r % 256)]))
    return F.when(m.contains(":"), _ip6(m, key)).otherwise(_let(_ip_parts(m), of))


def _as_date(m: Column, form: str, where: str) -> Column:
    d = F.when(m.rlike(where), F.try_to_timestamp(m, F.lit(form)).cast("date"))
    return F.when((d >= F.to_date(F.lit(_EPOCH))) & (d < F.to_date(F.lit("2100-01-01")))
                  & (F.date_format(d, form) == m), d)


def _is_date(m: Column) -> Column:
    return F.coalesce(*[_as_date(m, form, where) for where, form in _FORMATS]).isNotNull()


def _date(m: Column, key: str) -> Column:
    def moved(form: str):
        def of(d: Column) -> Column:
            day = F.datediff(d, F.to_date(F.lit(_EPOCH)))
            new = feistel(F.floor(day / _DAYS[1]), day % _DAYS[1], F.lit(_DAYS[0]), F.lit(_DAYS[1]), F.lit("date"), key)
            return _let(new, lambda s: F.date_format(
                F.date_add(F.to_date(F.lit(_EPOCH)), (s.l * _DAYS[1] + s.r).cast("int")), form))
        return of
    return F.coalesce(*[_let(_as_date(m, form, where), moved(form)) for where, form in _FORMATS])


def _hashed(value: Column, key: str, tag: str) -> Column:
    parts = [F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"{tag}{i}"), value), 256) for i in range(2)]
    return F.concat(*parts)


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("user."), F.substring(_hashed(F.lower(m), key, "email"), 1, 12), F.lit("@example.org"))


def _secret(m: Column, key: str) -> Column:
    front = F.regexp_extract(m, r'^(?:AKIA|ASIA)(?=[0-9A-Z]{16}$)|^gh[pousr]_|^xox[abprs]-|^AIza(?=.{35}$)'
                                r'|^[A-Za-z_\-]+[ \t]?[=:][ \t]?"?', 0)
    value = F.substring(m, F.length(front) + 1, F.length(m))
    new = _let(_hashed(value, key, "secret"), lambda h: F.rpad(h, F.length(value), h))  # a longer value repeats it
    plain = F.concat(front, F.when(value == F.upper(value), F.upper(new)).otherwise(new))
    block = F.concat(F.regexp_extract(m, "^-----BEGIN [A-Z ]+-----", 0), F.lit("\n"), F.substring(_hashed(
        m, key, "secret"), 1, 64), F.lit("\n"), F.regexp_extract(m, "-----END [A-Z ]+-----$", 0))
    return F.when(m.startswith("-----"), block).otherwise(plain)


def _replacement(m: Column, key: str) -> Column:
    """Struct (kind, new) of one match; kind is null where the value fails its check."""
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    valid = {"email": F.lit(True), "secret": F.lit(True), "iban": _is_iban(m), "phone": _is_phone(m),
             "ssn": _is_ssn(m), "date": _is_date(m), "ip": _is_ip(m), "card": _is_card(m)}
    new = {"email": _email(m, key), "secret": _secret(m, key), "iban": _iban(m, key), "phone": _phone(m, key),
           "ssn": _ssn(m, key), "date": _date(m, key), "ip": _ip(m, key), "card": _card(m, key)}
    kind, value = F, F
    for k in KINDS:
        kind = kind.when(whole[k], F.when(valid[k], F.lit(k)))
        value = value.when(whole[k], F.when(valid[k], new[k]).otherwise(m))
    return F.struct(kind.alias("kind"), value.otherwise(m).alias("new"))


def pseudonymised(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars",
                  key: str) -> DataFrame:
    """(row, text, kinds): ``row`` a struct of all columns of ``docs``, ``text`` the whole text with
    pseudonyms, ``kinds`` the kind of each replaced value in order of place.

    A null text stays null, an empty one empty, and neither has kinds. Repeated rows get equal
    results. Other columns ride along in ``row``, so their names can't clash. An empty table gives
    an empty result."""
    t = F.col("text")
    hit = t.rlike(_HINT)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.select("row", "text", hit.alias("hit"), F.when(hit, _accounts(t)).alias("accounts"))
    rows = rows.select("row", "text", "hit", _pattern(F.col("accounts")).alias("pattern"))
    rows = rows.select("row", "text", "pattern", F.when(F.col("hit"), F.regexp_extract_all(t, F.col("pattern"), F.lit(0)))
                                                 .otherwise(none).alias("found"))
    rows = rows.select("row", "text", "pattern", F.when(
        F.size("found") > 0, F.transform("found", lambda m: _replacement(m, key))).alias("new"))
    rebuilt = F.array_join(F.zip_with(F.split(t, F.col("pattern"), -1), "new", lambda gap, n: F.concat(
        gap, F.coalesce(n["new"], F.lit("")))), "")
    return rows.select("row", F.when(F.col("new").isNull(), t).otherwise(rebuilt).alias("text"),
                       F.coalesce(F.filter(F.transform("new", lambda n: n.kind), lambda k: k.isNotNull()), none)
                        .alias("kinds"))


def redacted(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars", key: str) -> DataFrame:
    """``docs`` with pseudonyms in the text; ``length_col``, if there is one, follows changed texts."""
    out = pseudonymised(docs, text_col=text_col, key=key)
    cols = []
    for f in docs.schema.fields:
        old = F.col("row")[f.name]
        if f.name == text_col:
            old = F.col("text")
        elif f.name == length_col:
            old = F.when(F.size("kinds") > 0, F.length("text")).otherwise(old).cast(f.dataType)
        cols.append(old.alias(f.name))
    return out.select(*cols)
