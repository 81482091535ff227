"""Secret scan by dictionary-primed zstandard novelty (operator 1).

Candidates are strings that three plain patterns name (kinds ``assign``, ``access``,
``hex``) and strings of 12 characters or more with a letter that stand near a sensitive
word (kind ``novel``): at most 64 characters after it, on its line or the next one that
is not blank, or before it on its line. Each candidate is measured by its marginal
compressed bytes: the size of its surroundings with it less the size without it, by
zstandard primed with a dictionary of identifiers, common ones and those that the text
itself repeats. Words that the dictionary or the surroundings explain cost few bytes; a
random string costs most of its length. Other copies of a candidate are cut out of its
surroundings first: a secret that is written twice is a secret.

Pattern candidates always stay, with their measure. A ``novel`` candidate is reported
if it overlaps no pattern candidate and costs at least ``min_novelty`` bytes per byte;
strings under 16 characters, of letters only or before the word need ``min_alone``,
which natural words do not reach.

Places are code points, end exclusive. Defined cases: a null text is the empty text,
without findings. A null ``doc_id`` stays null, repeated rows are scanned each, other
columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import per_row, texts_of

MIN_NOVELTY = 0.6
MIN_ALONE = 0.9
SURROUNDINGS = 256
OWN_IDENTIFIERS = 4096  # bytes of the text's own names in the dictionary, the commonest
KINDS = ("assign", "access", "hex", "novel")

# The patterns of the three kinds.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE_WORDS = (
    "access", "apikey", "api_key", "auth", "bearer", "cert", "connection", "cookie",
    "credential", "dsn", "hmac", "jwt", "key", "login", "nonce", "pass", "pin", "private",
    "pwd", "salt", "secret", "session", "sign", "token",
)
IDENTIFIERS = (
    "access_key api_key apikey auth_token authorization bearer client_id client_secret "
    "config connection_string const credentials database default description domain "
    "endpoint environment example export false function getenv header hostname http "
    "https import index int json key let license localhost login message name none null "
    "object options organization params password path placeholder port private_key "
    "property public_key query refresh_token region request response return secret "
    "secret_key secretKey self server session session_id signature static string test "
    "timestamp token true undefined user user_id username value variable version void "
    "changeme your_api_key your_token_here xxxxxxxx 00000000 12345678 0123456789abcdef "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ .com .org .net www. mail. "
)
_CONTEXT = re.compile("|".join(SENSITIVE_WORDS), re.IGNORECASE | re.ASCII)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.~-]{12,}={0,2}")
_NAME = re.compile("[A-Za-z_]{4,}")
_LONG = 16
_REACH = 64
_HEX_CLASS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * MIN_HEX

Span = tuple[str, int, int]


class Scanner:
    """Finds and measures candidates in one text after the other."""

    def __init__(
        self,
        min_novelty: float = MIN_NOVELTY,
        min_alone: float = MIN_ALONE,
        identifiers: str = IDENTIFIERS,
    ):
        import zstandard

        self._zstd = zstandard
        # Small inputs: the shortest matches count, so that syllables of words do.
        self._level = zstandard.ZstdCompressionParameters.from_level(
            19, min_match=3, write_checksum=False, write_content_size=False
        )
        self._identifiers = identifiers.encode()
        self._common = self._primed(b"")
        self._min_novelty, self._min_alone = min_novelty, min_alone

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(kind, start, end, novelty) by start, then kind as listed."""
        low = text.lower()
        named = pattern_spans(text, low)
        near = []
        if any(word in low for word in SENSITIVE_WORDS):
            near = _without(_in_context(text), named)
        if not named and not near:
            return []
        size_of = self._primed(_own_names(text, [text[a:b] for a, b, _ in near]))
        found = [(*span, self.novelty(text, *span[1:], size_of)) for span in named]
        for start, end, alone in near:
            novelty = self.novelty(text, start, end, size_of)
            if novelty >= (self._min_alone if alone else self._min_novelty):
                found.append(("novel", start, end, novelty))
        return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))

    def novelty(self, text: str, start: int, end: int, size_of=None) -> float:
        """Marginal compressed bytes per byte of ``text[start:end]``."""
        size_of = size_of or self._common
        middle = text[start:end].encode("utf-8", "replace")
        around = b"".join(
            part.encode("utf-8", "replace").replace(middle, b"")
            for part in (text[max(0, start - SURROUNDINGS) : start], text[end : end + SURROUNDINGS])
        )
        return max(0, size_of(around + middle) - size_of(around)) / max(1, len(middle))

    def _primed(self, names: bytes):
        known = self._zstd.ZstdCompressionDict(
            names + self._identifiers, dict_type=self._zstd.DICT_TYPE_RAWCONTENT
        )
        compress = self._zstd.ZstdCompressor(
            compression_params=self._level, dict_data=known
        ).compress
        return lambda data: len(compress(data))


def pattern_spans(text: str, low: str) -> list[Span]:
    """The candidates the three patterns name. ``low`` is the text in lower case."""
    spans: list[Span] = []
    if any(word in low for word in ASSIGN_WORDS):
        spans += [
            ("assign", *match.span())
            for match in ASSIGN.finditer(text)
            if len(match[2]) >= MIN_ASSIGNED
        ]
    if "AKIA" in text:
        spans += [
            ("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS
        ]
    if _HEX_RUN in text.encode("utf-8", "replace").translate(_HEX_CLASS):
        spans += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _own_names(text: str, candidates: list[str]) -> bytes:
    """Names that the text repeats and that are part of no candidate, commonest first."""
    if not candidates:
        return b""
    doubted = {name for string in candidates for name in _NAME.findall(string)}
    names = Counter(_NAME.findall(text))
    own = sorted(
        (name for name, n in names.items() if n > 1 and name not in doubted),
        key=lambda name: (-names[name], name),
    )
    return " ".join(own).encode()[:OWN_IDENTIFIERS] + b" "


def _without(near: list[tuple[int, int, bool]], named: list[Span]) -> list[tuple[int, int, bool]]:
    """Strings that overlap no named span."""
    starts = [start for _, start, _ in named]
    ends: list[int] = []  # the furthest end of the spans up to each
    for _, _, end in named:
        ends.append(max(end, ends[-1] if ends else 0))
    kept = []
    for start, end, alone in near:
        before = bisect_left(starts, end)
        if not before or ends[before - 1] <= start:
            kept.append((start, end, alone))
    return kept


def _in_context(text: str) -> list[tuple[int, int, bool]]:
    """Strings near a sensitive word, and whether their novelty alone must tell."""
    starts, ends = [], []
    for word in _CONTEXT.finditer(text):
        starts.append(word.start())
        ends.append(word.end())
    places = []
    for match in _CANDIDATE.finditer(text):
        start, end = match.span()
        string = match[0]
        if not any(c.isalpha() for c in string):
            continue
        # The last word that begins before the string ends, and the first after it.
        last = bisect_left(starts, end) - 1
        follows = last >= 0 and (ends[last] > start or _leads(text[ends[last] : start]))
        after = bisect_right(starts, end - 1)
        precedes = after < len(starts) and starts[after] - end <= _REACH
        precedes = precedes and "\n" not in text[end : starts[after]]
        if follows or precedes:
            mixed = any(c.isdigit() for c in string)
            places.append((start, end, not (follows and mixed and len(string) >= _LONG)))
    return places


def _leads(between: str) -> bool:
    """Whether a string after this much text still belongs to the word before it."""
    if len(between) > _REACH:
        return False
    return not any(line.strip() for line in between.split("\n")[1:-1])


def find_secrets(
    docs: DataFrame,
    min_novelty: float = MIN_NOVELTY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id`` and ``findings``: array of (kind, start, end, novelty)."""

    def scanner():
        scan = Scanner(min_novelty).scan
        return lambda doc_id, text: [
            (
                doc_id,
                [
                    {"kind": kind, "start": start, "end": end, "novelty": novelty}
                    for kind, start, end, novelty in scan(text)
                ],
            )
        ]

    schema = "doc_id long, findings array<struct<kind:string,start:int,end:int,novelty:double>>"
    return per_row(texts_of(docs, id_col, text_col), schema, ("doc_id", "text"), scanner)


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts, a checksum of the pattern spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    def text_of(findings):
        return F.array_join(
            F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
        )

    base = F.filter("findings", lambda f: f["kind"] != "novel")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(F.col("findings")).alias("spans"),
        count("novel").alias("n_novel"),
    )
