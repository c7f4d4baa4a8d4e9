"""PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

Card numbers (Luhn), phone numbers, IPv4 addresses, social security numbers, calendar dates and
the names in e-mail addresses are found, validated, and replaced by the value that a keyed
permutation of their format gives. A value is read as a list of numbers, each with its own
radix; a Feistel network adds keyed hashes of one half to the other, number by number and modulo
its radix, and so permutes exactly the values of that format. The first digits of a phone
number's area code and exchange are permuted among 2 to 9 or among 0 and 1, so that the numbers
which may be dialled and the others are permuted each among themselves. Equal values get equal pseudonyms
in all documents, however they are punctuated; different ones stay different; cards stay valid
under Luhn, octets below 256, dates dates. Without the key nothing can be traced back; with it
the permutation can be inverted.

There is no shuffle and no state: linking follows from the key alone.

Defined cases: a null text stays null; texts without candidates are unchanged; candidates that
fail validation are unchanged; repeated rows give equal rows; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm.common import read

KEY = "change this key"
ROUNDS = 8
KINDS = ("card", "phone", "ip", "ssn", "date", "email")

# Each pattern starts at the start of a run, so that long runs are read once.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_YEAR = "(?:1[7-9]|20)[0-9]{2}"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,9}"
DATE = rf"(?<![0-9./-])(?:{_YEAR}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}([./])[0-9]{{1,2}}\1{_YEAR})(?![0-9]|[./-][0-9])"
IP = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9]|-[0-9])"
# A +1 or brackets tell a number by themselves, so any digits will do there; bare groups need codes from 2 on.
_HOME = r"(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}"
_BRACKETS = r"(?:(?<![0-9+(-])1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}"
_BARE = r"(?<![0-9+(-])(?:1[ .-]?)?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}"
#: Other countries: 8 to 15 digits, and no decimal number.
_ABROAD = r"(?<![0-9+])\+(?![0-9]+\.[0-9]+(?![0-9]|[ .-]\(?[0-9]))[2-9](?:[ .-]?\(?[0-9]\)?){7,14}"
PHONE = rf"(?:{_HOME}|{_BRACKETS}|{_BARE}|{_ABROAD})(?![0-9])"
#: Country codes of one and two digits; all others but 1 have three.
_COUNTRY = "^(7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|3[0-9]{3}([ -])[0-9]{6}\3[0-9]{5})(?![0-9])"
ANY = "|".join((EMAIL, DATE, IP, SSN, PHONE, CARD))

DAY_ZERO = "date'1700-01-01'"
#: 400 years are 146,097 days: 189 times 773.
DAY_RADICES = (189, 773)


def _let(value: str, name: str, body: str) -> str:
    """body with name bound to value, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _luhn(payload: str) -> str:
    """The check digit that completes a string of digits."""
    digit = f"cast(substr({payload}, length({payload}) - i + 1, 1) as int)"
    total = f"aggregate(sequence(1, length({payload})), 0, (n, i) -> n + if(i % 2 = 1, {digit} * 2 - if({digit} > 4, 9, 0), {digit}))"
    return f"(10 - {total} % 10) % 10"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _day_parts(m: str) -> str:
    """(y, m, d, form) of a date; a month over 12 after a slash is read month first."""
    nums = f"transform(split({m}, '[./-]'), x -> cast(x as int))"
    return _let(
        nums,
        "n",
        f"""if(n[0] > 31, named_struct('y', n[0], 'm', n[1], 'd', n[2], 'form', 'ymd'),
            if(n[1] > 12 and {m} like '%/%', named_struct('y', n[2], 'm', n[0], 'd', n[1], 'form', 'mdy'),
               named_struct('y', n[2], 'm', n[1], 'd', n[0], 'form', 'dmy')))""",
    )


_VALID_DAY = """(p.m between 1 and 12 and p.d between 1 and
  case when p.m in (4, 6, 9, 11) then 30 when p.m = 2 then if(p.y % 4 = 0 and (p.y % 100 != 0 or p.y % 400 = 0), 29, 28) else 31 end)"""

_KIND = f"""case
  when m like '%@%' then 'email'
  when m like '+%' then 'phone'
  when m rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 'ssn'
  when m rlike '^[0-9]+([.][0-9]+){{3}}$' then 'ip'
  when m rlike '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[./][0-9]{{1,2}}[./][0-9]{{4}})$' then if({_let(_day_parts('m'), 'p', _VALID_DAY)}, 'date', '')
  when length({_digits('m')}) <= 11 then 'phone'
  when {_let(_digits('m'), 'g', f"{_luhn('left(g, length(g) - 1)')} = cast(right(g, 1) as int)")} then 'card'
  else '' end"""

# Where the numbers that are permuted stand in the match: a list of positions.
_POSITIONS = f"""case kind
  when 'card' then slice(filter(sequence(1, length(m)), p -> substr(m, p, 1) rlike '[0-9]'), 1, length(regexp_replace(m, '[^0-9]', '')) - 1)
  when 'phone' then if(m rlike '^[+][2-9]',
    slice(filter(sequence(1, length(m)), p -> substr(m, p, 1) rlike '[0-9]'), length(regexp_extract(regexp_replace(m, '[^0-9]', ''), '{_COUNTRY}', 1)) + 1, 15),
    slice(filter(sequence(1, length(m)), p -> substr(m, p, 1) rlike '[0-9]'), length(regexp_replace(m, '[^0-9]', '')) - 9, 10))
  when 'email' then filter(sequence(1, instr(m, '@') - 1), p -> substr(m, p, 1) rlike '[A-Za-z0-9]')
  else cast(array() as array<int>) end"""

_CHARACTERS = """transform(pos, (p, i) -> transform(array(substr(m, p, 1)), c -> case
  when kind = 'phone' and m not rlike '^[+][2-9]' and i in (0, 3) then
    if(c < '2', named_struct('v', ascii(c) - 48L, 'r', 2L, 'low', 48), named_struct('v', ascii(c) - 50L, 'r', 8L, 'low', 50))
  when c rlike '[0-9]' then named_struct('v', ascii(c) - 48L, 'r', 10L, 'low', 48)
  when c rlike '[a-z]' then named_struct('v', ascii(c) - 97L, 'r', 26L, 'low', 97)
  else named_struct('v', ascii(c) - 65L, 'r', 26L, 'low', 65) end)[0])"""

_AREA = "cast(left(m, 3) as bigint)"
_NUMBERS = f"""case kind
  when 'ip' then transform(split(m, '[.]'), x -> named_struct('v', cast(x as bigint), 'r', 256L, 'low', 0))
  when 'ssn' then array(
    named_struct('v', {_AREA} - if({_AREA} > 666, 2L, 1L), 'r', 898L, 'low', 0),
    named_struct('v', cast(substr(m, 5, 2) as bigint) - 1L, 'r', 99L, 'low', 0),
    named_struct('v', cast(right(m, 4) as bigint) - 1L, 'r', 9999L, 'low', 0))
  when 'date' then {_let(_let(_day_parts('m'), 'p', f"cast(datediff(make_date(p.y, p.m, p.d), {DAY_ZERO}) as bigint)"), 'n',
    f"array(named_struct('v', n div {DAY_RADICES[1]}L, 'r', {DAY_RADICES[0]}L, 'low', 0), named_struct('v', n % {DAY_RADICES[1]}L, 'r', {DAY_RADICES[1]}L, 'low', 0))")}
  else {_CHARACTERS} end"""


def _feistel(key: str, rounds: int) -> str:
    """The permuted values of list t.numbers; kind and radices belong to the hash's input."""

    def added(side: str, other: str, first: str) -> str:
        heard = f"concat_ws('|', {key}, t.kind, cast(r as string), cast(size(t.numbers) as string), array_join(cast(s.{other} as array<string>), ','), cast(i as string))"
        return f"transform(s.{side}, (x, i) -> pmod(x + cast(conv(substr(sha2({heard}, 256), 1, 15), 16, 10) as bigint), t.numbers[{first}].r))"

    half = "cast(size(t.numbers) div 2 as int)"
    values = "transform(t.numbers, x -> x.v)"
    return f"""aggregate(sequence(1, {rounds}),
      named_struct('a', slice({values}, 1, {half}), 'b', slice({values}, {half} + 1, size(t.numbers))),
      (s, r) -> if(r % 2 = 1,
        named_struct('a', {added('a', 'b', 'i')}, 'b', s.b),
        named_struct('a', s.a, 'b', {added('b', 'a', f'i + {half}')})),
      s -> concat(s.a, s.b))"""


_SPELT = """concat_ws('', transform(sequence(1, length(t.m)), p -> transform(array(array_position(t.pos, p)), k ->
  if(k > 0, char(element_at(t.numbers, cast(k as int)).low + element_at(t.out, cast(k as int))), substr(t.m, p, 1)))[0]))"""
_DAY = f"""transform(array(struct(date_add({DAY_ZERO}, cast(t.out[0] * {DAY_RADICES[1]} + t.out[1] as int)) as day, {_day_parts('t.m')}.form as form,
    if(t.m like '%/%', '/', '.') as dot)), p ->
  case p.form when 'ymd' then date_format(p.day, 'yyyy-MM-dd')
    when 'mdy' then concat_ws(p.dot, date_format(p.day, 'MM'), date_format(p.day, 'dd'), date_format(p.day, 'yyyy'))
    else concat_ws(p.dot, date_format(p.day, 'dd'), date_format(p.day, 'MM'), date_format(p.day, 'yyyy')) end)[0]"""
_WRITTEN = f"""case t.kind
  when 'ip' then array_join(cast(t.out as array<string>), '.')
  when 'ssn' then concat_ws('-', lpad(cast(t.out[0] + if(t.out[0] >= 665, 2, 1) as string), 3, '0'),
    lpad(cast(t.out[1] + 1 as string), 2, '0'), lpad(cast(t.out[2] + 1 as string), 4, '0'))
  when 'date' then {_DAY}
  when 'card' then {_let(_SPELT, 'w', f"concat(left(w, length(w) - 1), {_let(_digits('w'), 'g', _luhn('left(g, length(g) - 1)'))})")}
  when '' then t.m
  else {_SPELT} end"""


def pseudonymised(docs: DataFrame, key: str = KEY, text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The columns of docs with the text replaced, then a struct `replaced` of counts per kind; a
    column of that name in docs gives way."""
    name = f"`{text_column}`"
    any_pattern, secret = _quoted(ANY), _quoted(key)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = docs.select(
        row.alias("row"),
        F.col(name).alias("text"),
        F.expr(f"if({name} rlike '[0-9@]', regexp_extract_all({name}, {any_pattern}, 0), cast(array() as array<string>))").alias("found"),
    )
    # Each step is a list of structs with one more part; candidates that fail validation have no kind.
    steps = found.withColumn("found", F.expr(f"transform(found, m -> named_struct('m', m, 'kind', {_KIND}))"))
    steps = steps.withColumn("found", F.expr(f"transform(found, t -> named_struct('m', t.m, 'kind', t.kind, 'pos', {_in(_POSITIONS)}))"))
    steps = steps.withColumn("found", F.expr(f"transform(found, t -> named_struct('m', t.m, 'kind', t.kind, 'pos', t.pos, 'numbers', {_in(_NUMBERS)}))"))
    steps = steps.withColumn(
        "found", F.expr(f"transform(found, t -> named_struct('m', t.m, 'kind', t.kind, 'pos', t.pos, 'numbers', t.numbers, 'out', {_feistel(secret, rounds)}))")
    )
    steps = steps.withColumn("written", F.expr(f"transform(found, t -> {_WRITTEN})"))
    text = F.expr(f"if(size(written) = 0, text, concat_ws('', zip_with(split(text, {any_pattern}, -1), written, (p, w) -> concat(p, coalesce(w, '')))))")
    counts = [F.expr(f"cast(size(filter(found, t -> t.kind = '{k}')) as bigint)").alias(k) for k in KINDS]
    out = steps.select("row", text.alias("text"), F.struct(*counts).alias("replaced"))
    return out.select(*[(F.col("text") if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c.lower() != "replaced"], "replaced")


def _in(body: str) -> str:
    """A step's text with its bare names taken from the list element t."""
    return _let("t.m", "m", _let("t.kind", "kind", _let("t.pos", "pos", body) if "pos" in body else body))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymised(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "text", *[F.col(f"replaced.{k}").alias(f"n_{k}") for k in KINDS])
