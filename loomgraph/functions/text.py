"""Column functions on names and texts. Each stage of the graph pipeline has its own normaliser; none is shared."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Noise removed from texts, in order.
NOISE = (
    r"Try it Yourself.*?»",
    r"❮\s*Previous\s*Next\s*❯",
    r"W3Schools is optimized",
    r"Spaces.*?Tutorials.*?References",
)
# Spellings by stage, keyed by the lower-case name.
EXTRACT_NAMES = {
    "string": "String", "integer": "Integer", "arraylist": "ArrayList", "hashmap": "HashMap", "list": "List", "map": "Map", "set": "Set",
}
VALIDATE_NAMES = {
    "string": "String", "integer": "Integer", "int": "Integer", "double": "Double", "float": "Float", "boolean": "Boolean",
    "char": "Character", "arraylist": "ArrayList", "hashmap": "HashMap", "list": "List", "set": "Set", "map": "Map",
}
GROWTH_TYPES = ("string", "int", "integer", "double", "float", "boolean", "char")
GROWTH_NAMES = {
    "arraylist": "ArrayList", "hashmap": "HashMap", "hashset": "HashSet", "linkedlist": "LinkedList",
    "exception": "Exception", "interface": "Interface", "class": "Class", "method": "Method",
}
TUNER_NAMES = {
    "string": "String", "arraylist": "ArrayList", "hashmap": "HashMap", "exception": "Exception", "integer": "Integer",
    "list": "List", "map": "Map", "set": "Set", "collection": "Collection",
}


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def number(c: Column) -> Column:
    """A double as Python and DuckDB write it: the fewest digits that name it, and an exponent below 1e-4 and from 1e16 on."""
    # Java 17 gives some numbers a digit too many, so the digits are those of the library that Spark writes JSON with
    java = F.reflect(F.lit("com.fasterxml.jackson.core.io.NumberOutput"), F.lit("toString"), F.coalesce(c, F.lit(0.0)), F.lit(True))
    sign, exp = F.regexp_extract(java, "^-?", 0), F.regexp_extract(java, r"E(-?\d+)", 1).cast("int")
    digits = F.rtrim(F.regexp_replace(java, r"E.*|[-.]", ""), F.lit("0"))
    tail = F.substring(digits, F.lit(2), F.lit(17))
    whole = F.concat(F.substring(F.rpad(digits, F.lit(17), "0"), F.lit(1), exp + 1), F.lit("."), F.when(F.length(digits) > exp + 1, F.substring(digits, exp + 2, F.lit(17))).otherwise("0"))
    one = F.format_string("%.0e", c)  # Java never gives one digit alone
    return (
        F.when(c.isNull(), None).when(F.isnan(c), "nan").when(F.abs(c) == float("inf"), F.concat(sign, F.lit("inf"))).when(~java.contains("E"), java)
        .when(exp == -4, F.concat(sign, F.lit("0.000"), digits)).when((exp >= 7) & (exp < 16), F.concat(sign, whole))
        .when(one.cast("double") == c, one).otherwise(F.concat(sign, F.substring(digits, 1, 1), F.lit("."), tail, F.format_string("e%+03d", exp)))
    )


def lookup(names: dict[str, str], key: Column) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(names.items())))[key]


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def capitalised(c: Column) -> Column:
    """First character upper, the rest lower (not initcap, which works word by word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def camel(c: Column) -> Column:
    """snake_case to camelCase; the parts after the first are capitalised."""
    parts = F.split(c, "_")
    rest = F.transform(F.slice(parts, 2, 1 << 20), capitalised)
    return F.concat(parts[0], F.array_join(rest, ""))


def preprocess(c: Column) -> Column:
    """Entities, runs of white space and page noise become spaces, then the ends are stripped; null becomes empty."""
    out = F.regexp_replace(F.coalesce(c, F.lit("")), "&[a-zA-Z]+;", " ")
    out = F.regexp_replace(out, r"(?U)\s+", " ")
    for noise in NOISE:
        out = F.regexp_replace(out, f"(?isU){noise}", " ")
    return strip(out)


def extract_entity(c: Column) -> Column:
    """Entity names at extraction: known spellings, else only word characters and dots, first letter upper."""
    s = strip(F.coalesce(c, F.lit("")))
    return F.coalesce(lookup(EXTRACT_NAMES, F.lower(s)), upper_first(F.regexp_replace(s, r"(?U)[^\w.]", "")))


def extract_relation(c: Column) -> Column:
    """Relation names at extraction: lower case first, so isTypeOf becomes istypeof; snake case becomes camel case."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(s == "", F.lit("relatedTo")).when(s.contains("_"), camel(s)).otherwise(F.regexp_replace(s, r"(?U)[^\w]", ""))


def validate_entity(c: Column) -> Column:
    s = strip(F.coalesce(c, F.lit("")))
    return F.coalesce(lookup(VALIDATE_NAMES, F.lower(s)), capitalised(s))


def growth_entity(c: Column) -> Column:
    s = strip(F.coalesce(c, F.lit("")))
    k = F.lower(s)
    return F.when(k.isin(*GROWTH_TYPES), F.concat(F.lit("DataType_"), capitalised(s))).otherwise(F.coalesce(lookup(GROWTH_NAMES, k), capitalised(s)))


def growth_relation(c: Column) -> Column:
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(s.contains("_"), camel(s)).otherwise(s)


def tuner_entity(c: Column) -> Column:
    """Known spellings; any other name keeps its text, blanks included."""
    return F.coalesce(lookup(TUNER_NAMES, F.lower(strip(c))), c)


def load_relation(c: Column) -> Column:
    """A relationship type: separators to underscores, other signs dropped, a letter first."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \-.]", "_"), r"[^\p{L}\p{N}_]", "")
    return F.when(s == "", F.lit("RELATED_TO")).when(~s.rlike(r"^\p{L}"), F.concat(F.lit("REL_"), s)).otherwise(s)


def ellipsis(c: Column, most: int) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)


def model_reply_json(c: Column) -> Column:
    """What a model's reply holds from its first brace to its last, null without one."""
    got = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(got == "", None).otherwise(got)
