"""Column expressions (JVM-side, codegen-friendly). No Python UDFs."""

from rankforge.functions.scalar import (
    binary_relabel_expr,
    clean_name,
    first_hit_field,
    free_text_query,
    fielded_query,
    hash_bucket,
    hash_order,
    json_field,
    normalize_text,
    quote,
    rank_class,
    to_csv_line,
)
from rankforge.functions.lines import repair_line_struct

__all__ = [
    "binary_relabel_expr", "clean_name", "first_hit_field", "free_text_query",
    "fielded_query", "hash_bucket", "hash_order", "json_field", "normalize_text",
    "quote", "rank_class", "to_csv_line", "repair_line_struct",
]
