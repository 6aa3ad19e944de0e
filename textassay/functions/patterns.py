"""Regular expressions in Java syntax, arranged for speed.

In a Java character class, single characters below 256 share one table lookup, while every range and
property is tested in turn. So the frequent characters are spelled out first, and the Unicode
properties only see what is left. ``(?U)`` makes \\s the Unicode White_Space property.
"""

from dataclasses import dataclass

# --- fixed values ---------------------------------------------------------------------------
# Whitespace: White_Space and the four separators U+001C to U+001F.
SPACE_MEMBERS = r"\s\x1c-\x1f"
SPACE = f"(?U)[{SPACE_MEMBERS}]"
NOT_SPACE = f"(?U)[^{SPACE_MEMBERS}]"
LATIN_SPACES = r" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"

HTML_TAG = r"<[^>]*+>"

# Characters deleted by the shingle normaliser and by the lexicon tokeniser (both after lower()).
ASCII_ALNUM = "abcdefghijklmnopqrstuvwxyz0123456789"
SPANISH_LETTERS = "áéíóúüñ"
NOT_SHINGLE_CHARS = rf"(?U)[[^{ASCII_ALNUM}{SPANISH_LETTERS}{LATIN_SPACES}]&&[^\p{{L}}\p{{N}}\s]]+"
NOT_TOKEN_CHARS = rf"(?U)[[^{ASCII_ALNUM}{SPANISH_LETTERS}{LATIN_SPACES}]&&[^\s]]+"

# Word boundary next to a digit, as "no word character before / after". The literal U+10000 (a letter
# itself) makes the lookbehind step over whole code points instead of surrogates.
NO_WORD_BEFORE = "(?<![\\p{L}\\p{N}_\U00010000])"
NO_WORD_AFTER = r"(?![\p{L}\p{N}_])"

# Case-insensitive Unicode matching lets these four characters stand for i, s and k.
CASE_FOLD_EXTRAS = "ıİſK"
LETTERS = f"a-zA-Z{CASE_FOLD_EXTRAS}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"


@dataclass(frozen=True)
class PiiPattern:
    """One category of personal data.

    ``fp_rate`` is the documented share of false hits. Only "is there a match" is ever asked, so a
    pattern is written in the cheapest form with the same answer: a leading ``x+`` is cut to ``x``, a
    trailing ``{2,}`` to ``{2}``, and the rarest character is tested first.
    """

    category: str
    pattern: str
    fp_rate: float
    fp_note: str

    @property
    def column(self) -> str:
        return f"pii_{self.category}"


PII_PATTERNS = (
    PiiPattern(
        "email",
        rf"@(?<=[{LETTERS}0-9._%+\-]@)[{LETTERS}0-9.\-]+\.[{LETTERS}]{{2}}",
        0.03,
        "< 3%",
    ),
    PiiPattern(
        "telefono",
        rf"(?U)[36](?:(?<=3)[0-9]{{2}}|(?<=6)0[1-8])[{SPACE_MEMBERS}]*[0-9]{{3}}[{SPACE_MEMBERS}]*[0-9]{{4}}",
        0.18,
        "~18%",
    ),
    PiiPattern(
        "ipv4",
        rf"(?=[0-9]){NO_WORD_BEFORE}(?:{OCTET}\.){{3}}{OCTET}{NO_WORD_AFTER}",
        0.42,
        "~42%",
    ),
    PiiPattern(
        "cedula",
        rf"(?=[1-9]){NO_WORD_BEFORE}(?:[1-9][0-9]{{2,3}}(?:\.[0-9]{{3}}){{2}}|[1-9][0-9]{{7,9}}){NO_WORD_AFTER}",
        0.65,
        "> 65%",
    ),
    PiiPattern(
        "credenciales_url",
        rf"(?U)https?://[^{SPACE_MEMBERS}:@]+:[^{SPACE_MEMBERS}:@]+@[^{SPACE_MEMBERS}/]",
        0.12,
        "~12%",
    ),
)
# --------------------------------------------------------------------------------------------
