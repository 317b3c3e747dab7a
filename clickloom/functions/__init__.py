from clickloom.functions.scalars import (
    OCCUPATION_BUCKETS, OCCUPATION_BUCKETS_LITERAL, OTHER_BUCKET, STAR_BUCKETS, STAR_BUCKETS_LITERAL,
    code_bucket, digamma, hash_unit, last_element, list_element, list_length, local_time, ratio,
    smoothed_rate, time_parts,
)

__all__ = [
    "OCCUPATION_BUCKETS", "OCCUPATION_BUCKETS_LITERAL", "OTHER_BUCKET", "STAR_BUCKETS",
    "STAR_BUCKETS_LITERAL", "code_bucket", "digamma", "hash_unit", "last_element", "list_element",
    "list_length", "local_time", "ratio", "smoothed_rate", "time_parts",
]
