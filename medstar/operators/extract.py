"""Header (H1–H7) and patient-fact (F1–F8, P4, P5) extraction operators.

Both return the kept columns, the extracted columns and ``err`` (null for
a good document).  ``good`` / ``rejects`` split such a result; when both are
needed, persist or write the parsed result once so each document is parsed
once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hl7
from ..functions.hl7 import FACT_COLUMNS, FACT_FIELDS, HEADER_FIELDS
from ..functions.xml_paths import extract_udf, with_extract

HEADER_COLUMNS = [f.name for f in HEADER_FIELDS]

# from_xml schema of the header: every element whose count matters is an array.
_HEADER_XML_SCHEMA = (
    "realmCode array<struct<_code:string>>, "
    "id array<struct<_root:string,_extension:string>>, "
    "code array<struct<_code:string>>, "
    "title array<string>, "
    "effectiveTime array<struct<_value:string>>, "
    "languageCode array<struct<_code:string>>, "
    "_corrupt_record string")
_FROM_XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false",
                     "ignoreNamespace": "true",
                     "columnNameOfCorruptRecord": "_corrupt_record"}


def _keep_cols(df: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in keep]


def extract_header(df: DataFrame, content: str = "content",
                   keep: Sequence[str] = ("path",), engine: str = "exact",
                   on_error: str = "reject") -> DataFrame:
    """Header cells of each document.

    ``engine='exact'`` parses once in an Arrow-batched UDF with the exact
    node-set rules.  ``engine='jvm'`` uses ``from_xml`` and stays in the JVM;
    it differs on two inputs only: a title with child elements keeps their
    markup, and text after the document element is accepted.
    """
    if engine == "exact":
        out = with_extract(df, keep, content, HEADER_FIELDS, "_h", on_error)
        return out.select(*keep, *[F.col(f"_h.{c}").alias(c) for c in HEADER_COLUMNS],
                          F.col("_h.err").alias("err"))
    if engine != "jvm":
        raise ValueError("engine must be 'exact' or 'jvm'")
    # The parse sits inside a one-element generator: a later filter on its
    # fields cannot be pushed below a Generate, so Catalyst cannot inline
    # from_xml into every predicate (which would parse each document once
    # per reference).
    parsed = F.from_xml(F.col(content), _HEADER_XML_SCHEMA, _FROM_XML_OPTIONS)
    x = df.select(*_keep_cols(df, keep), F.col(content).isNull().alias("_null"),
                  F.explode(F.array(parsed)).alias("_x"))

    def one(arr: str, attr: str, name: str):
        a = F.col(f"_x.{arr}")
        ok = (F.size(a) == 1) & F.get(a, 0)[attr].isNotNull()
        return (F.when(ok, F.get(a, 0)[attr]),
                F.when(~ok | a.isNull(), F.lit(f"{name}: no single match for {arr}/@{attr[1:]}")))

    cells = {
        "row_key": one("id", "_extension", "row_key"),
        "id": one("id", "_root", "id"),
        "typeCode": one("code", "_code", "typeCode"),
        "effectiveTime": one("effectiveTime", "_value", "effectiveTime"),
        "realmCode": one("realmCode", "_code", "realmCode"),
        "languageCode": one("languageCode", "_code", "languageCode"),
    }
    title = F.coalesce(F.array_join(F.col("_x.title"), ""), F.lit(""))
    err = F.coalesce(
        F.when(F.col("_null"), F.lit("content: null")),
        F.when(F.col("_x._corrupt_record").isNotNull(), F.lit("content: malformed XML")),
        *[cells[c][1] for c in HEADER_COLUMNS if c != "title"])
    if on_error == "fail":
        err = F.when(err.isNotNull(), F.raise_error(F.concat(F.lit("header: "), err)))
    values = [F.when(err.isNull(), title if c == "title" else cells[c][0]).alias(c)
              for c in HEADER_COLUMNS]
    return x.select(*keep, *values, err.alias("err"))


def parse_fact(df: DataFrame, content: str = "content",
               keep: Sequence[str] = ("row_key",), on_error: str = "reject",
               engine: str = "exact") -> DataFrame:
    """Eight patient-fact columns of each document plus ``err``.

    ``engine='jvm'`` gives the same rows and reasons: documents of the regular
    shape are read by ``from_xml`` in the JVM, and only the others are parsed
    by the exact engine in Python.
    """
    if engine == "jvm":
        return _parse_fact_jvm(df, content, keep, on_error)
    if engine != "exact":
        raise ValueError("engine must be 'exact' or 'jvm'")
    out = with_extract(df, keep, content, FACT_FIELDS, "_f", on_error)
    addr = F.concat(F.col("_f._city"), F.lit(" "), F.col("_f._county"))   # C4
    cols = [addr.alias(c) if c == "addr" else F.col(f"_f.{c}").alias(c)
            for c in FACT_COLUMNS]
    return out.select(*keep, *cols, F.col("_f.err").alias("err"))


def _path_schema(paths: Sequence[str]) -> str:
    """from_xml schema of child paths: every element an array, attributes and
    texts as strings."""
    tree: dict = {}
    for path in paths:
        at = tree
        for step in path.split("/"):
            at = at.setdefault(step, {})

    def fields(node: dict) -> str:
        return ", ".join(
            f"`_{k[1:]}`: string" if k.startswith("@") else
            f"`{k}`: array<{f'struct<{fields(v)}>' if v else 'string'}>" for k, v in node.items())

    return fields(tree)


# Child paths that a regular document has; the descendant steps of the two
# others are child steps in it, which the numbers of tags prove.
_MAIN_DOC = "authenticator/assignedEntity/id/@extension"
_OUT_SICK = ("component/structuredBody/component/section/entry/observation/code/qualifier/name/"
             "@displayName")
_CHILD_PATHS = [hl7.ID_CARD_PATH, hl7.GENDER_PATH, hl7.AGE_PATH, hl7.COUNTY_PATH, hl7.CITY_PATH,
                hl7.IN_TIME_PATH, hl7.IN_CLASS_PATH, _MAIN_DOC, _OUT_SICK]
_FACT_XML_SCHEMA = f"struct<{_path_schema(_CHILD_PATHS)}, _corrupt_record: string>"

_COUNTED = ["authenticator", "component", "entry"]
_ROOT = r"^[ \t\r\n]*(?:<\?xml\s[^>]*\?>\s*)?<([A-Za-z_][\w.:-]*)[\s>]"


def _plain(c: Column) -> Column:
    """Whether both parsers read a text alike: one element and nothing but it,
    whose prefixes are declared in its tag; no comments, CDATA, document types,
    instructions, references but the five, characters of two UTF-16 units, or
    prefixed names of attributes that count.  Others may be well-formed too."""
    name = F.regexp_extract(c, _ROOT, 1)
    # its end tag comes once, and last
    end, body = F.concat(F.lit("</"), name), F.rtrim(c, F.lit(" \t\r\n"))
    once = body.endswith(F.concat(end, F.lit(">"))) & (
        F.instr(c, end) == F.length(body) - F.length(end))
    used = F.regexp_extract_all(c, F.lit(r"(?:</?|\s)([A-Za-z_][\w.-]*):[A-Za-z_]"), F.lit(1))
    declared = F.regexp_extract_all(F.regexp_extract(c, r"<[A-Za-z_][^>]*>", 0),
                                    F.lit(r"\sxmlns:([\w.-]+)\s*="), F.lit(1))
    odd = c.contains("<!") | c.contains("]]>") | (F.instr(F.substring(c, 8, 1 << 30), "<?") > 0)
    for attr in ("extension", "code", "value", "displayName"):
        odd = odd | c.contains(f":{attr}")
    odd = odd | F.when(c.contains("&"), c.rlike("&(?!(?:amp|lt|gt|quot|apos);)")).otherwise(False)
    odd = odd | F.when(F.octet_length(c) > F.length(c), c.rlike(r"[\x{10000}-\x{10FFFF}]|\x{FEFF}")
                       ).otherwise(False)
    return F.coalesce((name != "") & ~odd & once & (F.size(F.array_except(
        used, F.concat(declared, F.array(F.lit("xml"), F.lit("xmlns"))))) == 0), F.lit(False))


def _nodes(root: str, path: str) -> tuple[Column, str | None]:
    """The node set of a child path (without its attribute step), and the name
    of the attribute."""
    steps = path.split("/")
    attr = steps.pop()[1:] if steps[-1].startswith("@") else None
    nodes = F.col(f"{root}.{steps[0]}")
    for step in steps[1:]:
        nodes = F.flatten(F.filter(F.transform(F.filter(nodes, lambda n: n.isNotNull()),
                                               _field(step)), lambda x: x.isNotNull()))
    return nodes, attr


def _values(root: str, path: str) -> Column:
    """Attribute values of a node set (null: a node without), or its texts."""
    nodes, attr = _nodes(root, path)
    return F.transform(nodes, _field(f"_{attr}")) if attr else nodes


def _field(name: str):
    return lambda n: n[name]


def _parse_fact_jvm(df: DataFrame, content: str, keep: Sequence[str], on_error: str) -> DataFrame:
    c = F.col(content)
    # every parse sits inside a one-element generator, see extract_header
    x = df.select(*keep, c.alias("_content"), F.explode(F.array(F.from_xml(
        F.when(_plain(c), c), _FACT_XML_SCHEMA, _FROM_XML_OPTIONS))).alias("_x"))
    c = F.col("_content")
    size = lambda a: F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0))
    # node sets and numbers of tags, each worked out once
    sets = {p: _values("_x", p).alias(f"v{i}") for i, p in enumerate(_CHILD_PATHS)}
    at = {p: F.col(f"_s.v{i}") for i, p in enumerate(_CHILD_PATHS)}
    tags = F.regexp_extract_all(c, F.lit(
        rf"<(?:[\w.-]+:)?({'|'.join(_COUNTED)})[\s/>]"), F.lit(1))
    y = x.select(*keep, "_content", F.explode(F.array(F.when(
        F.col("_x").isNotNull() & F.col("_x._corrupt_record").isNull(), F.struct(
            *sets.values(), tags.alias("tags"), size(F.col("_x.authenticator")).alias("authenticator"),
            (size(F.col("_x.component")) + size(_nodes(
                "_x", "component/structuredBody/component/@x")[0])).alias("component"),
            size(_nodes("_x", "component/structuredBody/component/section/entry/@x")[0])
            .alias("entry"))))).alias("_s"))
    only = lambda path: F.when(size(at[path]) == 1, F.get(at[path], 0))
    first = lambda path: F.coalesce(F.get(at[path], 0), F.lit(""))
    main, sick = at[_MAIN_DOC], at[_OUT_SICK]
    attending = F.filter(main, lambda e: F.substring(e, hl7.ATTENDING_CHAR_POS + 1, 1)
                         == hl7.ATTENDING_CHAR)
    diseases = F.filter(sick, lambda e: e.startswith(hl7.DISEASE_PREFIX))
    regular = [
        # no such element elsewhere: descendants are these children
        *[F.size(F.filter("_s.tags", _equals(t))) == F.col(f"_s.{t}") for t in _COUNTED],
        *[only(p).isNotNull() for p in (hl7.ID_CARD_PATH, hl7.GENDER_PATH, hl7.IN_CLASS_PATH)],
        only(hl7.AGE_PATH).rlike(r"^[+-]?[0-9]{1,9}$"),
        # an element within a text would be kept as its markup
        *[(size(at[p]) == 1) & ~first(p).contains("<") for p in (hl7.COUNTY_PATH, hl7.CITY_PATH)],
        F.length(only(hl7.IN_TIME_PATH)) >= hl7.MONTH_KEY_LEN,
        ~F.exists(F.coalesce(main, F.array()), lambda e: F.coalesce(F.length(e), F.lit(0))
                  <= hl7.ATTENDING_CHAR_POS),
        ~F.exists(F.coalesce(sick, F.array()), lambda e: F.coalesce(F.length(e), F.lit(99))
                  < len(hl7.DISEASE_PREFIX)),
    ]
    all_ = F.lit(True)
    for r in regular:
        all_ = all_ & F.coalesce(r, F.lit(False))
    values = {
        "idCard": F.substr(only(hl7.ID_CARD_PATH), F.lit(hl7.ID_CARD_PREFIX_LEN + 1)),
        "genderId": only(hl7.GENDER_PATH),
        "ageId": _truncated(only(hl7.AGE_PATH).try_cast("int"), hl7.AGE_BAND_WIDTH),
        "addr": F.concat(first(hl7.CITY_PATH), F.lit(" "), first(hl7.COUNTY_PATH)),
        "inTimeId": F.substring(only(hl7.IN_TIME_PATH), 1, hl7.MONTH_KEY_LEN),
        "inClassId": only(hl7.IN_CLASS_PATH),
        "mainDocId": F.when(size(attending) == 1, F.get(attending, 0)).otherwise(""),
        "outSickId": F.when(size(diseases) == 1, F.get(diseases, 0)),
    }
    # a document that wasn't read has nothing to look at
    w = y.select(*keep, "_content", F.explode(F.array(F.when(F.col("_s").isNotNull(), F.struct(
        all_.alias("regular"), *[v.alias(n) for n, v in values.items()])))).alias("_j"))
    regular = F.coalesce(F.col("_j.regular"), F.lit(False))
    rest = extract_udf(FACT_FIELDS)(F.when(~regular, F.col("_content")))
    z = w.select(*keep, "_j", rest.alias("_p")).select(
        *keep, "_j", F.explode(F.array("_p")).alias("_f"))
    missing = F.lit(f"outSickId: no single match for {hl7.OUT_SICK_PATH}")
    err = F.when(regular, F.when(F.col("_j.outSickId").isNull(), missing)).otherwise(
        F.col("_f.err"))
    if on_error == "fail":
        err = F.when(err.isNotNull(), F.raise_error(F.concat(F.lit("fact: "), err)))
    addr = F.concat(F.col("_f._city"), F.lit(" "), F.col("_f._county"))
    cols = [F.when(regular, F.when(F.col("_j.outSickId").isNotNull(), F.col(f"_j.{n}")))
            .otherwise(addr if n == "addr" else F.col(f"_f.{n}")).alias(n) for n in FACT_COLUMNS]
    return z.select(*keep, *cols, err.alias("err"))


def _equals(value: str):
    return lambda x: x == value


def _truncated(a: Column, b: int) -> Column:
    """Integer division truncating toward zero, as text."""
    return F.when(a < 0, -F.floor(-a / b)).otherwise(F.floor(a / b)).cast("string")


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("err").isNull()).drop("err")


def rejects(parsed: DataFrame, key: str = "row_key") -> DataFrame:
    """``(key, field, reason)`` for every rejected document."""
    bad = parsed.filter(F.col("err").isNotNull())
    field = F.split_part(F.col("err"), F.lit(":"), F.lit(1))
    return bad.select(F.col(key), field.alias("field"), F.col("err").alias("reason"))


def patient_fact(docs: DataFrame, content: str = "content", keep: Sequence[str] = ("row_key",),
                 on_error: str = "reject", engine: str = "exact") -> DataFrame:
    """Good fact rows only; use ``parse_fact`` + ``rejects`` to see the rest."""
    return good(parse_fact(docs, content, keep, on_error, engine))
