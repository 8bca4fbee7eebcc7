"""Removal of personal data."""

from pyspark.sql import Column, functions as F

from .. import fixed
from .text import EDGE, SPACE, WORD

# Fixed patterns, over Unicode letters, digits and whitespace.
EMAIL = rf"{EDGE}[{WORD}.+\-]+@[{WORD}\-]+\.[{WORD}.\-]+{EDGE}"
CREDENTIAL = rf"(?iu){EDGE}(?:Bearer|token|api[_-]?key)[{SPACE}]*[=:]?[{SPACE}]*[^{SPACE}]{{8,}}"
NUMBER = rf"{EDGE}(?:\p{{Nd}}[ -]?){{13,19}}{EDGE}"


def client_hash(client: Column, salt: str) -> Column:
    """Salted hash of a client; null for null and for empty text."""
    return F.when(client != "", F.substring(F.sha2(F.concat(F.lit(f"{salt}|"), client), 256), 1, 32))


def scrub_text(text: Column) -> Column:
    """Replace e-mail addresses, then credentials, then numbers of 13 to 19 digits."""
    text = F.regexp_replace(text, EMAIL, fixed.EMAIL_MARK)
    text = F.regexp_replace(text, CREDENTIAL, fixed.CREDENTIAL_MARK)
    return F.regexp_replace(text, NUMBER, fixed.NUMBER_MARK)
