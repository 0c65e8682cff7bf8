"""Document field access and typed search fields.

Documents are parsed once into a VARIANT column (``try_parse_json``); every
field is then a ``try_variant_get`` on that column, so one row is parsed
once no matter how many fields are projected.  Ranges are structs
``<lo, hi, lo_inc, hi_inc>`` (Spark has no range type).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPARK_TYPE = {"string": "string", "double": "double", "integer": "int", "datetime": "string",
               "double-range": "double", "integer-range": "int", "datetime-range": "string",
               "numeric-range": "double", "float-range": "double"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_path(path: Sequence[str]) -> str:
    """['properties', 'eo:cloud_cover'] → $['properties']['eo:cloud_cover']."""
    parts = []
    for p in path:
        if isinstance(p, int) or (isinstance(p, str) and p.isdigit()):
            parts.append(f"[{int(p)}]")
        else:
            parts.append("['" + str(p).replace("'", "\\'") + "']")
    return "$" + "".join(parts)


def doc_variant(text) -> Column:
    """Parse JSON text once; NULL when it is not valid JSON."""
    return F.try_parse_json(_c(text))


def get_path(doc, path: Sequence[str], typ: str = "string") -> Column:
    """F1 ``#>>``: the value at ``path`` as ``typ`` (NULL when missing or not
    convertible).  ``typ='variant'`` gives ``#>`` (the sub-document)."""
    if typ == "variant":
        return F.try_variant_get(_c(doc), json_path(path), "variant")
    return F.try_variant_get(_c(doc), json_path(path), typ)


def common_timestamp(text) -> Column:
    """text → zone-less timestamp; a trailing offset is ignored (the
    value is read as UTC wall time), digits past microseconds truncated."""
    # The cast to a zone-less timestamp reads wall time and drops any offset.
    return _c(text).try_cast("timestamp_ntz")


def make_range(lo, hi, bounds: str = "[]") -> Column:
    """F19 constructor: ``bounds`` is '[]', '[)', '(]' or '()'."""
    return F.struct(_c(lo).alias("lo"), _c(hi).alias("hi"),
                    F.lit(bounds[0] == "[").alias("lo_inc"), F.lit(bounds[1] == "]").alias("hi_inc"))


def range_overlaps(a, b) -> Column:
    """F19 ``&&``: ranges share at least one point (inclusivity honoured;
    a NULL bound is unbounded)."""
    a, b = _c(a), _c(b)

    def before(x_hi, x_inc, y_lo, y_inc):  # x ends before y starts
        return F.coalesce((x_hi < y_lo) | ((x_hi == y_lo) & ~(x_inc & y_inc)), F.lit(False))
    return ~before(a["hi"], a["hi_inc"], b["lo"], b["lo_inc"]) & \
        ~before(b["hi"], b["hi_inc"], a["lo"], a["lo_inc"])


def range_contains(r, v) -> Column:
    """F19 ``@>`` for a point."""
    r, v = _c(r), _c(v)
    lo_ok = F.coalesce(F.when(r["lo_inc"], v >= r["lo"]).otherwise(v > r["lo"]), F.lit(True))
    hi_ok = F.coalesce(F.when(r["hi_inc"], v <= r["hi"]).otherwise(v < r["hi"]), F.lit(True))
    return lo_ok & hi_ok


def search_field(doc, spec: dict) -> Column:
    """One declared search field as a typed Column.

    ``offset`` → single path; ``min_offset``/``max_offset`` → null-skipping
    ``least`` / ``greatest`` (F18) over the paths, as a closed range.
    """
    typ = spec.get("type", "string")
    st = _SPARK_TYPE.get(typ, "string")

    def one(path):
        v = get_path(doc, path, st)
        return common_timestamp(v) if typ.startswith("datetime") else v

    if "offset" in spec:
        return one(spec["offset"])
    lo = [one(p) for p in spec["min_offset"]]
    hi = [one(p) for p in spec["max_offset"]]
    lo_c = lo[0] if len(lo) == 1 else F.least(*lo)
    hi_c = hi[0] if len(hi) == 1 else F.greatest(*hi)
    return make_range(lo_c, hi_c, "[]")


def search_field_columns(doc, fields: dict) -> list[Column]:
    """The whole declaration as a list of aliased Columns."""
    return [search_field(doc, spec).alias(name) for name, spec in fields.items()]


def flatten_ranges(df, names: Sequence[str]):
    """Range structs → ``<name>_lo``/``<name>_hi`` columns (for output)."""
    cols = []
    for c in df.columns:
        if c in names:
            cols += [F.col(c)["lo"].alias(f"{c}_lo"), F.col(c)["hi"].alias(f"{c}_hi")]
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ---------------------------------------------------------------- schema-on-read

_LEAF = {"string": "string", "double": "double", "int": "int", "integer": "int", "bigint": "bigint"}


def paths_schema(specs) -> str:
    """DDL of a nested struct holding only the given (path, type) leaves.

    Parsing a document with ``from_json`` and this schema reads just the
    needed fields (the streaming parser skips everything else); a node that
    is requested both as a leaf and as a parent is kept as JSON text."""
    tree: dict = {}
    for path, typ in specs:
        node = tree
        for i, k in enumerate(path):
            last = i == len(path) - 1
            if last:
                if k in node and isinstance(node[k], dict):
                    node[k] = "string"
                elif k not in node:
                    node[k] = _LEAF.get(typ, "string")
            else:
                if not isinstance(node.get(k, {}), dict):
                    break
                node = node.setdefault(k, {})

    def ddl(n):
        return "struct<" + ", ".join(
            f"`{k}`: " + (ddl(v) if isinstance(v, dict) else v) for k, v in n.items()) + ">"
    return ddl(tree)


def parse_paths(text, specs) -> Column:
    """Parse JSON text once into a struct of the requested paths."""
    return F.from_json(_c(text), paths_schema(specs))


def at(struct_col, path) -> Column:
    """Nested field of a ``parse_paths`` struct (NULL when absent)."""
    c = _c(struct_col)
    for k in path:
        c = c.getField(k)
    return c


def field_specs(fields: dict) -> list:
    """(path, leaf type) pairs a declaration reads."""
    out = []
    for spec in fields.values():
        typ = _SPARK_TYPE.get(spec.get("type", "string"), "string")
        for p in ([spec["offset"]] if "offset" in spec else spec["min_offset"] + spec["max_offset"]):
            out.append((list(p), typ))
    return out


def search_field_struct(parsed, spec: dict) -> Column:
    """P2 on a ``parse_paths`` struct: one declared field as a typed Column."""
    typ = spec.get("type", "string")

    def one(path):
        v = at(parsed, path)
        return common_timestamp(v) if typ.startswith("datetime") else v
    if "offset" in spec:
        return one(spec["offset"])
    lo = [one(p) for p in spec["min_offset"]]
    hi = [one(p) for p in spec["max_offset"]]
    return make_range(lo[0] if len(lo) == 1 else F.least(*lo), hi[0] if len(hi) == 1 else F.greatest(*hi), "[]")
