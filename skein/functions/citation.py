"""Citation algebra: addresses, numerals, ranges, grammar, natural order.  Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.text import bind_sql, norm, text_of

# Fixed values of the address grammar.
NUMBER = r"\d+\.\d+(?:-\d+)?"
CITATION = rf"^{NUMBER}(?:\([A-Za-z0-9]+\))*$"
SUBPART = r"(?i)^subpart\s+\d+\.\d+$"
PART = r"(?i)^part\s+\d+$"
#: Level names below a section, outermost first, and the depth of every level name.
PARAGRAPH_LEVELS = ["paragraph", "subparagraph", "subunit-depth-1", "subunit-depth-2", "subunit-depth-3", "subunit-depth-4"]
LEVEL_DEPTH = {"section": 0, "subsection": 0} | {n: i + 1 for i, n in enumerate(PARAGRAPH_LEVELS)}
#: Longest range that is expanded: digits and roman numerals, letters.
RANGE_CAP, LETTER_CAP = 40, 25


def components(number: Column) -> dict[str, Column]:
    """Part, subpart, section, subsection of a unit number; the section is the last two digits before the dash."""
    rest = F.when(number.contains("."), F.regexp_replace(number, r"^[^.]*\.", "")).otherwise(F.lit(""))
    pre = F.substring_index(rest, "-", 1)
    return {
        "part": F.substring_index(number, ".", 1),
        "subpart": F.when(F.char_length(pre) > 2, F.substring(pre, F.lit(1), F.char_length(pre) - 2)).otherwise(F.lit("")),
        "section": F.when(F.char_length(pre) > 2, F.substring(pre, -2, 2)).otherwise(pre),
        "subsection": F.when(rest.contains("-"), F.regexp_replace(rest, "^[^-]*-", "")).otherwise(F.lit("")),
    }


def decompose(number: Column, tokens: Column, levels: list[str]) -> dict[str, Column]:
    """Address fields down to the configured levels, '' below the tokens given."""
    return components(number) | {n: F.coalesce(F.get(tokens, F.lit(i)), F.lit("")) for i, n in enumerate(levels)}


def level_name(number: Column, depth: Column) -> Column:
    """P20: the level of a row; depth 0 is a subsection if its number has a dash."""
    out = F.when(depth == 0, F.when(number.contains("-"), "subsection").otherwise("section"))
    for i, n in enumerate(PARAGRAPH_LEVELS):
        out = out.when(depth == i + 1, n)
    return out


def href_to_citation(href: Column, prefix: str) -> Column:
    """P5: ``file#PREFIX_5_202`` to 5.202, ``PREFIX_Subpart_9_4`` to 'subpart 9.4', ``PREFIX_Part_19`` to 'part 19'.

    Other fragments stay as they are, an appended ``/id`` included.
    """
    frag = F.substring_index(text_of(href), "#", -1)
    rest = F.substring(frag, len(prefix) + 2, 1 << 20)
    t = F.split(rest, "_", -1)
    number = F.concat(F.get(t, F.lit(0)), F.lit("."), F.get(t, F.lit(1)), F.when(F.size(t) > 2, F.concat(F.lit("-"), F.array_join(F.slice(t, 3, 1 << 20), "-"))).otherwise(F.lit("")))
    after = lambda s: F.substring(frag, len(s) + 1, 1 << 20)
    return (
        F.when(frag.startswith(f"{prefix}_Subpart_"), F.concat(F.lit("subpart "), F.replace(after(f"{prefix}_Subpart_"), F.lit("_"), F.lit("."))))
        .when(frag.startswith(f"{prefix}_Part_"), F.concat(F.lit("part "), after(f"{prefix}_Part_")))
        .when(frag.startswith(f"{prefix}_") & (F.size(t) >= 2), number)
        .otherwise(frag)
    )


def norm_citation(c: Column) -> Column:
    """P9: 'subpart'/'part' references keep the last word; all others lose their spaces."""
    word = "concat('{0} ', substring_index(r.s, ' ', -1))".format
    return bind_sql(f"CASE WHEN lower(left(r.s, 7)) = 'subpart' THEN {word('subpart')} WHEN lower(left(r.s, 4)) = 'part' THEN {word('part')} ELSE replace(r.s, ' ', '') END", s=norm(c))


def split_alternate(c: Column) -> dict[str, Column]:
    """P10: (base, ROMAN) of a target that ends in 'Alternate II', with or without spaces."""
    rx = r"(?i)^(.*?) ?Alternate ?([IVX]+)$"
    s = norm(c)
    return {"base": F.when(s.rlike(rx), F.regexp_extract(s, rx, 1)).otherwise(s), "alternate": F.upper(F.regexp_extract(s, rx, 2))}


def section_root(c: Column) -> Column:
    """The leading unit number, else the input."""
    s = text_of(c)
    return F.coalesce(F.nullif(F.regexp_extract(s, f"^({NUMBER})", 1), F.lit("")), s)


def strip_agency(c: Column) -> Column:
    """Drop a leading 'ABC-' before a digit."""
    return F.regexp_replace(text_of(c), r"^[A-Za-z]+-(?=\d)", "")


def grammar_ok(c: Column) -> Column:
    """P15."""
    return c.rlike(CITATION) | c.rlike(SUBPART) | c.rlike(PART)


# The digits of roman numerals.
_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
_DIGIT = "CASE d " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _VALUES.items()) + " ELSE 0 END"


def roman_sql(of: str) -> str:
    """Value of a roman numeral: from the right, a digit below the largest so far is taken away."""
    digits = f"transform(split(reverse(lower({of})), ''), d -> {_DIGIT})"
    return f"aggregate({digits}, struct(0 AS n, 0 AS top), (a, v) -> struct(a.n + IF(v < a.top, -v, v) AS n, greatest(a.top, v) AS top), a -> a.n)"


def roman_value(c: Column) -> Column:
    """Value of a roman numeral in any case; other characters count 0; '' is 0."""
    return bind_sql(roman_sql("r.s"), s=text_of(c))


def is_roman(c: Column) -> Column:
    return F.lower(c).rlike("^[ivxlcdm]+$")


def roman_to_int(c: Column) -> Column:
    """P11 for ranges: null unless every character is a roman digit."""
    return F.when(is_roman(c), roman_value(c))


def alternate_number(c: Column) -> Column:
    """P11 for alternates: digits pass, roman numerals become arabic, anything without a value ''."""
    return bind_sql(f"CASE WHEN r.s = '' THEN '' WHEN r.s RLIKE '^[0-9]+$' THEN r.s ELSE coalesce(nullif(string({roman_sql('r.s')}), '0'), '') END", s=F.trim(text_of(c)))


def to_roman_sql(n: str) -> str:
    """Lower-case roman numeral of an integer, one decimal place at a time."""
    places = []
    for unit, (one, five, ten) in ((100, "cdm"), (10, "xlc"), (1, "ivx")):
        d = f"(({n}) div {unit} % 10)"
        places.append(f"CASE WHEN {d} = 9 THEN '{one}{ten}' WHEN {d} = 4 THEN '{one}{five}' ELSE concat(IF({d} > 4, '{five}', ''), repeat('{one}', int({d} % 5))) END")
    return f"concat(repeat('m', int(({n}) div 1000)), {', '.join(places)})"


def int_to_roman(n: Column) -> Column:
    """Lower-case roman numeral of an integer from 0 ('')."""
    return bind_sql(to_roman_sql("r.n"), n=n)


def members_sql(a: str, b: str) -> str:
    """``enumerate_tokens`` of two SQL expressions."""
    both = lambda rx: f"({a} RLIKE '{rx}' AND {b} RLIKE '{rx}')"
    cased = lambda x: f"IF(upper({a}) = {a}, upper({x}), {x})"

    def axis(start: str, end: str, least: int, most: int, label: str) -> str:
        ends = f"struct(bigint({start}) AS lo, bigint({end}) AS hi)"
        return f"get(transform(array({ends}), e -> CASE WHEN e.hi - e.lo BETWEEN {least} AND {most} THEN transform(sequence(e.lo, e.hi), n -> {label}) END), 0)"

    number = "try_cast({} AS decimal(38, 0))".format
    gap = f"({number(b)} - {number(a)})"
    far = f"CASE WHEN {gap} BETWEEN 0 AND {RANGE_CAP} THEN transform(sequence(0, int({gap})), i -> string(cast({number(a)} + i AS decimal(38, 0)))) END"
    return (
        f"CASE WHEN {both('^[0-9]{1,18}$')} THEN {axis(a, b, 0, RANGE_CAP, 'string(n)')} WHEN {both('^[0-9]{1,37}$')} THEN {far} WHEN (upper({a}) = {a}) <> (upper({b}) = {b}) THEN NULL "
        f"WHEN {both('^[ivxlcdmIVXLCDM]+$')} THEN CASE WHEN length({a}) > 1 OR length({b}) > 1 THEN {axis(roman_sql(a), roman_sql(b), 1, RANGE_CAP, cased(to_roman_sql('n')))} END "
        f"WHEN {both('^[A-Za-z]$')} THEN {axis(f'ascii(lower({a}))', f'ascii(lower({b}))', 0, LETTER_CAP, cased('char(n)'))} END"
    )


def enumerate_tokens(start: Column, end: Column) -> Column:
    """Explicit members of a range of labels, null where the axis is unsafe or the range too long.

    Digits; roman numerals when one end has several characters; single letters unless both are roman
    digits.  Ends of mixed case share no axis.  Case is kept.  Digits beyond a long are counted as decimals,
    and labels of over 37 digits are never expanded.
    """
    return bind_sql(members_sql("r.a", "r.b"), a=start, b=end)


def sort_key(target: Column) -> Column:
    """O3: an orderable array of (kind, number, text) cells for natural citation order.

    Addresses come first: three numbers, then labels on the ladder letters, digits, roman numerals,
    letters, digits, roman numerals; a label off its step sorts after those on it.  Other targets follow
    by their numbers, then by their text.
    """
    t = text_of(target)
    empty = F.lit("")
    cell = lambda k, n, s: F.struct(F.lit(k).alias("k"), F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("n"), s.cast("string").alias("s"))
    head = r"^(\d+)\.(\d+)(?:-(\d+))?"
    numbers = F.array(cell(0, F.lit(0), empty), *[cell(0, F.regexp_extract(t, head, i).try_cast("long"), empty) for i in (1, 2, 3)])
    labels = F.regexp_extract_all(F.regexp_replace(t, head, ""), F.lit(r"\(([A-Za-z0-9]+)\)"), F.lit(1))

    def ladder(x: Column, i: Column) -> Column:
        step = F.when(i < 6, i % 3).otherwise(0)
        off = cell(2, F.lit(0), F.lower(x))
        return (
            F.when(step == 0, cell(1, F.lit(0), F.lower(x)))
            .when(step == 1, F.when(x.rlike(r"^\d+$"), cell(0, x.try_cast("long"), empty)).otherwise(off))
            .otherwise(F.when(is_roman(x), cell(0, roman_value(x), empty)).otherwise(off))
        )

    found = F.regexp_extract_all(t, F.lit(r"\d+"), F.lit(0))
    nums = F.when(F.size(found) > 0, F.transform(found, lambda x: cell(0, x.try_cast("long"), empty))).otherwise(F.array(cell(0, F.lit(0), empty)))
    other = F.concat(F.array(cell(1, F.lit(0), empty)), nums, F.array(cell(-1, F.lit(0), t)))
    return F.when(t.rlike(head), F.concat(numbers, F.transform(labels, ladder))).otherwise(other)


def label_rank(c: Column) -> Column:
    """O2: rank of one label: a single letter by its place, digits by value, anything else 0."""
    return F.when(c.rlike("^[A-Za-z]$"), F.ascii(F.lower(c)) - 96).when(c.rlike(r"^\d+$"), c.try_cast("int")).otherwise(0)
