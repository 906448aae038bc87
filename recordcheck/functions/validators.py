"""Format and inconsistency validators (field -> boolean SQL expression text).

Every validator is *invalid?*: true only when the field has content and the
content breaks the check, so an empty or NULL field is never invalid here
(emptiness has its own rules).  All are regex / string built-ins.
"""

from __future__ import annotations

import re

from recordcheck import constants as K
from recordcheck.functions.predicates import (is_empty, is_filled, only_digits, regexp_replace,
                                              rlike, upper_trim)
from recordcheck.functions.sql import any_of, lit, x

# A "word character" for placeholder boundaries: letters, decimal digits,
# underscore and combining marks.  Written out instead of \b so the result does
# not depend on the JVM version's definition of \b.
_WORD = r"[\p{L}\p{Nd}\p{Mn}_]"


def placeholder_pattern(words=K.PLACEHOLDER_WORDS, unicode_case: bool = False) -> str:
    """Regex matching any placeholder word as a whole word.

    Case folding is ASCII-only by default (accented capitals do not fold), as
    specified; ``unicode_case=True`` folds every letter.
    """
    flags = "(?iu)" if unicode_case else "(?i)"
    alternatives = "|".join(re.escape(w).replace("\\ ", " ") for w in words)
    # Only places with some word's first letter are looked at any closer.
    first = "".join(dict.fromkeys(re.escape(w[0]) for w in words))
    return f"{flags}(?=[{first}])(?<!{_WORD})(?:{alternatives})(?!{_WORD})"


PLACEHOLDER_RE = placeholder_pattern()


def has_placeholder(c: str, pattern: str = PLACEHOLDER_RE) -> str:
    """V1: filled and contains a placeholder word (``NO APLICA``, ``N/A``...)."""
    return f"({is_filled(c)} AND {rlike(x(c), pattern)})"


def email_invalid(c: str) -> str:
    """V2: not an e-mail shape, or 4 equal characters in a row (ASCII case
    folded), or a user part made only of digits."""
    v = x(c)
    bad = (f"(NOT {rlike(v, K.EMAIL_SHAPE)} OR {rlike(v, K.EMAIL_REPEAT)} "
           f"OR {rlike(v, K.EMAIL_DIGIT_USER)})")
    return f"(CASE WHEN {is_empty(c)} THEN false ELSE {bad} END)"


def phone_invalid(c: str) -> str:
    """V3: digit count outside 7..8, or every digit the same."""
    d = only_digits(c)
    return (f"(CASE WHEN {is_empty(c)} THEN false ELSE length({d}) < 7 OR length({d}) > 8 "
            f"OR {rlike(d, K.ONE_DIGIT_PHONE)} END)")


def nit_invalid(c: str) -> str:
    """V4: tax id with fewer than 8 digits, a wrong ending (01..04 then 1..9),
    or any non-digit character besides whitespace."""
    d = only_digits(c)
    same_len = f"length({d}) = length({regexp_replace(x(c), r'\s+', '')})"
    return (f"({is_filled(c)} AND (length({d}) < 8 OR NOT {rlike(d, K.NIT_ENDING)} "
            f"OR NOT ({same_len})))")


def no_text_but_digits(e: str) -> str:
    """A filled text of ASCII digits only; one without a digit in front is not searched."""
    return f"(left({e}, 1) BETWEEN '0' AND '9' AND NOT {rlike(e, '[^0-9]')})"


def address_invalid(c: str, min_len: int = 5, pattern: str = PLACEHOLDER_RE) -> str:
    """V5: trimmed text shorter than ``min_len``, digits only, or a placeholder."""
    s = f"trim({x(c)})"
    return (f"({is_filled(c)} AND (length({s}) < {min_len} "
            f"OR {no_text_but_digits(s)} OR {rlike(x(c), pattern)}))")


def keyboard_run(c: str, runs=K.KEYBOARD_RUNS) -> str:
    """Upper-cased text contains one of the keyboard runs."""
    s = upper_trim(c)
    return "(" + " OR ".join(f"contains({s}, {lit(r)})" for r in runs) + ")"


def text_invalid(c: str, min_len: int = 3, runs=K.KEYBOARD_RUNS, pattern: str = PLACEHOLDER_RE) -> str:
    """V6: free text that is too short, digits only, a char 4 times in a row,
    a 1..3 char unit repeated 3+ times as the whole value, a keyboard run,
    3+ letters without a vowel, or a placeholder word."""
    v, s = x(c), upper_trim(c)
    letters = regexp_replace(s, f"[^{K.LETTERS_CLASS}]", "")       # made only for a text without a vowel
    parts = [
        f"length(trim({v})) < {min_len}",
        no_text_but_digits(v),
        rlike(s, K.REPEAT),
        keyboard_run(c, runs),
        f"(NOT {any_of(f'contains({s}, {lit(vowel)})' for vowel in K.VOWELS_CLASS)} AND length({letters}) >= 3)",
        rlike(v, pattern),
    ]
    return f"({is_filled(c)} AND (" + " OR ".join(parts) + "))"


def numeric_sequence(c: str, min_len: int = 4) -> str:
    """V7: at least ``min_len`` digits that are all one digit, or contain a
    4-digit ascending or descending run (wrapping 9->0)."""
    d = only_digits(c)
    repeated = rlike(d, r"^(\d)\1{" + str(min_len - 1) + r",}$")
    asc = rlike(d, "(" + "|".join(K.ASCENDING_RUNS) + ")")
    desc = rlike(d, "(" + "|".join(K.DESCENDING_RUNS) + ")")
    return f"({is_filled(c)} AND length({d}) >= {min_len} AND ({repeated} OR {asc} OR {desc}))"


def repeated_letters(c: str, min_rep: int = 4) -> str:
    """V8: the same letter ``min_rep`` or more times in a row."""
    return (f"({is_filled(c)} AND "
            f"{rlike(upper_trim(c), f'([{K.LETTERS_CLASS}])' + r'\1{' + str(min_rep - 1) + ',}')})")


def optional_text_inconsistent(c: str) -> str:
    """V9: V6 (min 3) or V8 (min 4)."""
    return f"({text_invalid(c, 3)} OR {repeated_letters(c, 4)})"


def optional_number_inconsistent(c: str) -> str:
    """V7 (min 4), meant for numeric optional fields."""
    return numeric_sequence(c, 4)
