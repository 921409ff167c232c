"""Column-expression functions: type coercion, change stamps, links."""

from keelson.functions.coerce import coerce, coerce_json, coerce_variant_column
from keelson.functions.stamps import absolute_link, typed_stamp

__all__ = ["absolute_link", "coerce", "coerce_json", "coerce_variant_column", "typed_stamp"]
