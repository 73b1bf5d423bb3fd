from .rules import (  # noqa: F401
    cents, floor_at_zero, from_cents, format_count, format_currency, is_even, is_non_blank,
    lookup, normalize_amount, normalize_date, normalize_id, normalize_label,
    normalize_text, null_tokens, office_label, state_full, strip_list_text,
)
