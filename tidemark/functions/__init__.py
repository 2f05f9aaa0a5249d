"""Column expressions: every function takes and returns Columns, nothing leaves the JVM."""

from .bands import bucketize, complete, valid_range
from .history import back_projection, day_index, growth, order_time, weekday_rate
from .keys import business_key, hash_bucket, hash_pick, hash_uniform, padded, record_hash, surrogate_key
from .measures import change_pct, mean, money, pct, ratio, weighted_mean
from .text import digits, email_domain, join_words, mask_email, slug, title_label

__all__ = [
    "back_projection", "bucketize", "business_key", "change_pct", "complete", "day_index",
    "digits", "email_domain", "growth", "hash_bucket", "hash_pick", "hash_uniform", "join_words",
    "mask_email", "mean", "money", "order_time", "padded", "pct", "ratio", "record_hash", "slug",
    "surrogate_key", "title_label", "valid_range", "weekday_rate", "weighted_mean",
]
