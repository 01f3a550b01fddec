"""Secret scans: fixed patterns, and strings that a tokenizer's vocabulary packs badly.

A byte-pair vocabulary packs words and code well and random strings badly. A run of
letters, digits and the signs of base 64 outside the fixed patterns' spans is reported as `random` if it has few characters
per token, unless it is a known kind of digest or identifier. The vocabulary is a parameter
(its file in the tiktoken format); it is read once and broadcast, as its size is fixed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import prepare

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Runs of at least so many characters are tested, and reported below so many per token.
MIN_RUN, CHARS_PER_TOKEN = 20, 2.0
#: Runs without a digit, which words are too, must be packed worse by this factor.
LETTERS = 0.85
Span = tuple[int, int, str]
KINDS = ("assign", "access", "hex", "random")

# The base patterns and their shortest matches.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_MIN_VALUE = 6

# Only these characters bound a run: scripts without spaces write letters right beside a string.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % MIN_RUN)
# Split as GPT-2 does: letters, digits, other signs.
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_DIGEST_LENGTHS = {32, 40, 48, 56, 64, 96, 128}  # of hex digits, MD5 to SHA-512
_IDENTIFIERS = re.compile(
    r"""
      [0-9]{4}-?[0-9]{2}-?[0-9]{2}[Tt_-]?[0-9Zz+-]*   # dates with times
    | [0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}   # UUID
    """,
    re.X,
)
_NUMBERED = re.compile(r"((?:[A-Za-z]+[/_+-]+)*[A-Za-z]+)[/_+-]*[0-9]+")  # names and paths with a number at the end
#: Fewer letters in front of a number are a name whatever they are.
MIN_NAME = 8
_PIECE = re.compile(r"[A-Za-z0-9+]{%d,}" % MIN_RUN)
_LETTER = re.compile(r"[A-Za-z]")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, by kind."""
    found = []
    # The pattern needs one of these stems; looking for them first is cheap.
    lowered = text.lower()
    if any(stem in lowered for stem in ("passw", "secret", "token", "api")):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _MIN_VALUE]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    return found + [(*m.span(), "hex") for m in _HEX.finditer(text)]


def is_digest(run: str) -> bool:
    """Hex digits in one case, as many as a common hash function gives."""
    digits = run.lower()
    return len(run) in _DIGEST_LENGTHS and run in (digits, run.upper()) and not re.search("[^0-9a-f]", digits)


def random_spans(
    text: str, base: list[Span], n_tokens: Callable[[str], int], chars_per_token: float = CHARS_PER_TOKEN
) -> list[Span]:
    """Runs with few characters per token that are no known digest or identifier.

    Runs that overlap a base span are left to it. Of a run that is not reported, the pieces
    between its signs are tested, so that a readable path in front hides nothing. Runs
    without a letter are numbers; those without a digit have a stricter ratio, by which the
    letters in front of a number at the end also pass as a name.
    """
    found = []

    def is_name(run: str) -> bool:
        m = _NUMBERED.fullmatch(run)
        front = m[1] if m else ""
        return bool(m) and (len(front) < MIN_NAME or len(front) / n_tokens(front) >= chars_per_token * LETTERS)

    def test(start: int, end: int) -> bool:
        run = text[start:end]
        if len(run) < MIN_RUN or not _LETTER.search(run) or is_digest(run) or _IDENTIFIERS.fullmatch(run) or is_name(run):
            return False
        most = chars_per_token if _MIXED.match(run) else chars_per_token * LETTERS
        if len(run) / n_tokens(run) >= most:
            return False
        found.append((start, end, "random"))
        return True

    for m in _RUN.finditer(text):
        if any(start < m.end() and m.start() < end for start, end, _ in base):
            continue
        run = m[0].strip("-_+/")
        at = m.start() + m[0].index(run)
        if not test(at, at + len(run)):
            for p in _PIECE.finditer(run):
                if len(p[0]) < len(run):
                    test(at + p.start(), at + p.end())
    return found


def joined(spans: list[Span]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """A vocabulary file of the tiktoken format: a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Offsets count code points, ends exclusive. base_sha256 is of the fixed patterns' spans
    alone; spans has those and the random ones, which never replace them. A null text is
    empty and has no spans. Repeated rows are each scanned; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))  # one vocabulary, some MB

    def run(batches):
        import tiktoken

        encoding = tiktoken.Encoding("scan", pat_str=_PIECES, mergeable_ranks=ranks.value, special_tokens={})

        def n_tokens(run: str) -> int:
            return len(encoding.encode_ordinary(run))

        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                extra = random_spans(text or "", base, n_tokens, chars_per_token)
                count = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*count, digest, joined(base + extra), len(extra)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
