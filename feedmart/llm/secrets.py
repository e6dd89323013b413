"""Secret scan: fixed patterns, and random strings that a token vocabulary compresses badly."""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from feedmart.llm.common import pick, sha256

KINDS = ("assign", "access", "hex", "random")

# The base patterns.
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_MIN, _ACCESS_MIN = 6, 20

# How the vocabulary cuts text before it merges bytes; belongs to the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


@dataclass(frozen=True)
class Efficiency:
    """When a run of characters counts as random: at least `shortest` long and under `chars_per_token`."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    pattern: str = PATTERN
    shortest: int = 20
    chars_per_token: float = 2.0


_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
_SRI = re.compile(r"sha(?:256|384|512)-[A-Za-z0-9+/]+={0,2}")
_SHA = re.compile(r"sha\d+:")
_URN = re.compile(r"urn:[a-z]+:")
_NAMELESS = re.compile(r"[^\w.:-]")  # ends what may be a host, a digest's name or a URN
_SCHEME = re.compile(r"://|\bwww\.", re.IGNORECASE)
_ADDRESS_END = re.compile(r"""[\s"'`<>,;|\\(){}\[\]]""")
_AUTHORITY_END = re.compile(r"[/?#]")
_QUERY = re.compile(r"[?#]")
_PATH_PART = re.compile(r"[^/]+")
_HOOK = re.compile(r"hook", re.IGNORECASE)  # addresses whose path is the secret


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns in code points, in order of start, then kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_MIN]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_MIN]
    # A run of fewer than 24 hides no longer one, so asking for 24 finds the runs that would be kept.
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass(frozen=True)
class Address:
    """Places in a text: where an address begins behind its scheme, ends, has its path, its last `@` before that, its query and the end of `hook`."""

    begin: int
    stop: int
    path: int
    user: int
    query: int
    hook: int


def addresses(text: str) -> list[Address]:
    """All addresses in order. One ends at quotes, commas, brackets or white space, or holds the next one.

    An address within another ends where that does, so what was found for the
    outer one is taken over if it lies behind; no text is gone through twice.
    """
    found: list[Address] = []
    for m in _SCHEME.finditer(text):
        begin, outer = m.end(), found[-1] if found and found[-1].stop >= m.end() else None
        first = lambda p, end: m.start() if (m := p.search(text, begin, end)) else end
        stop = outer.stop if outer else first(_ADDRESS_END, len(text))
        path = outer.path if outer and outer.path >= begin else first(_AUTHORITY_END, stop)
        if outer and outer.path == path:
            user = outer.user if outer.user >= begin else -1
        else:
            user = text.rfind("@", begin, path)
        query = outer.query if outer and outer.query >= begin else first(_QUERY, stop)
        hook = outer.hook if outer and outer.hook - 4 >= begin else first(_HOOK, stop) + 4
        found.append(Address(begin, stop, path, user, query, hook))
    return found


class Surroundings:
    """What runs of a text stand in. Runs are asked for in order; the text is gone through once, whatever its length."""

    def __init__(self, text: str):
        self.text = text
        self.addresses = addresses(text)
        self.urns = [m.span() for m in _URN.finditer(text)]
        self.seen = self.stretch = 0

    def in_address(self, start: int, end: int) -> Address | None:
        """The address that has the run in its host or path. User info, query, fragment and paths of webhooks do not count: they may be secrets."""
        i = bisect_right(self.addresses, end, key=lambda a: a.begin) - 1
        if i < 0 or self.addresses[i].stop < start:
            return None
        a = self.addresses[i]
        place = max(start, a.begin)
        secret = place < a.user or a.query < place or (a.hook <= end and end > a.path)
        return None if secret else a

    def named(self, start: int, end: int) -> bool:
        """Whether the run stands behind the name of a digest or in a URN, or is part of a host of several names behind `@`."""
        for m in _NAMELESS.finditer(self.text, self.seen, start):
            self.stretch = m.end()
        self.seen = start
        if _SHA.fullmatch(self.text, self.text.rfind("sha", max(self.stretch, start - 8), start), start):
            return True
        i = bisect_right(self.urns, start, key=lambda u: u[1]) - 1
        if i >= 0 and self.urns[i][0] >= self.stretch:
            return True
        if self.stretch == 0 or self.text[self.stretch - 1] != "@":
            return False
        return "." in self.text[self.stretch : start] or bool(re.match(r"\.[A-Za-z]", self.text[end : end + 2]))


def known(run: str) -> bool:
    """Whether the run is a digest, a UUID, a number or a line of marks."""
    return any(p.fullmatch(run) for p in (_UUID, _DIGEST, _SRI)) or not any(c.isalpha() for c in run)


def random_spans(text: str, taken: list[tuple[int, int, str]], runs: re.Pattern, encode, limit: float) -> list[tuple[int, int, str]]:
    """Runs outside the spans `taken` that are no known identifier and need many tokens for their length.

    The host of an address and the last part of its path are identifiers; each
    part before that is a run of its own (`https://api.example/bot<key>/send`).
    """
    found, i, reach = [], 0, 0
    around: Surroundings | None = None

    def costly(run: str) -> bool:
        # Words in capitals are as well known as others.
        return len(run) < limit * len(encode(run.lower() if run.isupper() else run)) and not known(run)

    for m in runs.finditer(text):
        start, end = m.span()
        while i < len(taken) and taken[i][0] < end:
            reach = max(reach, taken[i][1])
            i += 1
        if reach > start:
            continue
        whole = costly(m[0])
        if not whole and "/" not in m[0]:
            continue
        around = around or Surroundings(text)
        address = around.in_address(start, end)
        if address is None:
            if whole and not around.named(start, end):
                found.append((start, end, "random"))
            continue
        for part in _PATH_PART.finditer(text, max(start, address.path), end):
            if text[part.end() : part.end() + 1] == "/" and runs.fullmatch(part[0]) and costly(part[0]):
                found.append((*part.span(), "random"))
    return found


@lru_cache(maxsize=4)
def _encoding(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _scanner(spark: SparkSession, settings: Efficiency):
    """A function from text to all its spans. The vocabulary, one file of fixed size, travels with the tasks."""
    with open(settings.vocabulary, "rb") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    runs = re.compile(rf"[A-Za-z0-9+/_=-]{{{settings.shortest},}}")

    def scan(text: str) -> list[tuple[int, int, str]]:
        base = base_spans(text)
        encode = _encoding(vocabulary.value, settings.pattern).encode_ordinary
        extra = random_spans(text, base, runs, encode, settings.chars_per_token)
        return sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))

    return scan


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, settings: Efficiency = Efficiency()) -> DataFrame:
    """One row per row of `docs` (doc_id, text): counts by kind, a digest of the base spans, all spans.

    Spans are `kind:start:end` in code points, end exclusive, by start and then
    kind. A random run that touches a base span is not named again. A null or
    empty text has no spans. Repeated rows and null ids are scanned and
    returned like any other, further columns are left out. No shuffle.
    """
    scan = _scanner(docs.sparkSession, settings)

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                spans = scan(text.as_py() or "")
                base = [s for s in spans if s[2] != "random"]
                n = {kind: sum(s[2] == kind for s in spans) for kind in KINDS}
                out.append((doc_id, n["assign"], n["access"], n["hex"], sha256(_joined(base)), _joined(spans), n["random"]))
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pick(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each run of touching spans replaced by one mark that names the first span's kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[secret:{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, settings: Efficiency = Efficiency()) -> DataFrame:
    """All rows and columns of `docs`, secrets in `text` replaced by marks and `n_chars`, if there, counted anew.

    A null text stays null. Texts without a secret and their `n_chars` are unchanged.
    """
    scan = _scanner(docs.sparkSession, settings)

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            place = names.index("text")
            before = batch.column(place).to_pylist()
            after = [t if t is None else redact(t, scan(t)) for t in before]
            batch = batch.set_column(place, batch.schema.field(place), pa.array(after, batch.schema.field(place).type))
            if "n_chars" in names:
                at = names.index("n_chars")
                old = batch.column(at).to_pylist()
                new = [n if a == b else len(a) for n, a, b in zip(old, after, before)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
