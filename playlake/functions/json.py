"""JSON access with the warehouse's scalar-only semantics.

``json_scalar`` returns the text of a string, number or boolean at ``path`` and
NULL for JSON null, objects, arrays and missing paths.

``json_fields`` reads many top-level fields of a JSON text column at once with a
single ``from_json`` into STRING fields (the fast, vectorised path: a string
field receives the decoded text of a scalar, and the raw text of an object or
array).  Only a value whose text starts with '{' or '[' -- an object, an array,
or a string that happens to start that way -- takes the exact VARIANT check,
evaluated lazily inside the CASE branch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column | str) -> Column:
    """Parse JSON text into a VARIANT (strict: malformed text raises)."""
    return F.parse_json(F.col(text) if isinstance(text, str) else text)


def json_scalar(doc: Column, path: str) -> Column:
    """Scalar text at ``path`` of a VARIANT ``doc``; NULL for object/array/null."""
    node = F.variant_get(doc, path, "variant")
    kind = F.schema_of_variant(node)
    return (F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string"))
            .otherwise(F.variant_get(doc, path, "string")))


def json_fields(text: Column, names: Sequence[str]) -> Column:
    """Struct of the top-level ``names`` of JSON ``text``, each as raw STRING."""
    schema = "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">"
    return F.from_json(text, schema)


def looks_nested(raw_value: Column) -> Column:
    """Whether raw field text could be an object or array (NULL for NULL)."""
    return raw_value.startswith("{") | raw_value.startswith("[")


def any_suspicious(raw_values: Sequence[Column]) -> Column:
    """True when some raw field text could be an object or array."""
    cond = F.lit(False)
    for v in raw_values:
        cond = cond | F.coalesce(v.startswith("{") | v.startswith("["), F.lit(False))
    return cond


def suspicious_node(raw_value: Column, parsed: Column, name: str) -> Column:
    """The VARIANT node of field ``name``, only where its raw text looks like an
    object or array (NULL elsewhere).  Kept in a projection of its own so the
    VARIANT access is never evaluated for ordinary values."""
    suspicious = raw_value.startswith("{") | raw_value.startswith("[")
    return F.when(suspicious, F.variant_get(parsed, f"$.{name}", "variant"))


def resolve_scalar(raw_value: Column, node: Column) -> Column:
    """Scalar-only value: the raw text, unless ``node`` shows an object/array."""
    kind = F.schema_of_variant(node)
    return (F.when(node.isNull(), raw_value)
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string"))
            .otherwise(node.cast("string")))


def scalar_only(raw_value: Column, parsed: Column, name: str) -> Column:
    """Apply the scalar-only rule to a field read by ``json_fields`` (single
    expression form of ``suspicious_node`` + ``resolve_scalar``)."""
    suspicious = raw_value.startswith("{") | raw_value.startswith("[")
    return F.when(suspicious, json_scalar(parsed, f"$.{name}")).otherwise(raw_value)
