"""What the engine asks of the outside world, with deterministic stand-ins for tests.

Models, PDF and OCR programs and the network sit behind these interfaces; each is called from a
map over Arrow batches, so a failed task repeats its own batch only.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame


class RateLimited(Exception):
    pass


class TooManyTokens(Exception):
    pass


class Embedder(Protocol):
    dim: int

    def embed(self, texts: Sequence[str], input_type: str = "document") -> list[list[float]]: ...


class TextExtractor(Protocol):
    def extract(self, data: bytes) -> str: ...


class Fetcher(Protocol):
    def fetch(self, url: str) -> bytes | None: ...


class Translator(Protocol):
    def translate(self, text: str) -> str: ...


class HashingEmbedder:
    """Signed feature hashing of words, scaled to unit length."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, texts: Sequence[str], input_type: str = "document") -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.dim
            for w in (text or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                v[h % self.dim] += 1.0 if h >> 63 else -1.0
            norm = sum(x * x for x in v) ** 0.5
            out.append([x / norm for x in v] if norm else v)
        return out


def embed_with_retry(embedder: Embedder, texts: Sequence[str], attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """Five attempts: 25 s more each time the service is busy, powers of two else; too long a batch is halved."""
    for attempt in range(1, attempts + 1):
        try:
            return embedder.embed(texts)
        except TooManyTokens:
            if len(texts) < 2:
                raise
            half = len(texts) // 2
            return embed_with_retry(embedder, texts[:half], attempts, wait) + embed_with_retry(embedder, texts[half:], attempts, wait)
        except RateLimited:
            if attempt == attempts:
                raise
            wait(25.0 * attempt)
        except OSError:
            if attempt == attempts:
                raise
            wait(2.0**attempt)
    raise RuntimeError("no attempts")


def embed(df: DataFrame, embedder: Embedder, id_col: str = "id", text_col: str = "content", batch: int = 128) -> DataFrame:
    """(id, embedding): one call per ``batch`` rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                vectors = embed_with_retry(embedder, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(vectors, pa.list_(pa.float32()))], ["id", "embedding"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("id"), df[text_col].alias("t")).mapInArrow(run, f"id {kind}, embedding array<float>")


class ExtractorChain:
    """The first extractor whose text passes its own test."""

    def __init__(self, steps: Sequence[tuple[TextExtractor, Callable[[str], bool]]]):
        self.steps = steps

    def extract(self, data: bytes) -> str:
        for extractor, good in self.steps:
            try:
                text = extractor.extract(data)
            except Exception:  # a broken file is the next extractor's turn
                continue
            if good(text):
                return text
        return ""


#: A page library's text needs over 100 words, a layout program's over 1,000 characters.
over_100_words = lambda t: len(t.split()) > 100
over_1000_chars = lambda t: len(t) > 1000


def fetch(candidates: DataFrame, fetcher: Fetcher) -> DataFrame:
    """(key, priority, url, content): what each of a source's addresses gives; null where it fails.

    Taking the first usable one per source is ``operators.ingest.first_usable``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for url in b.column(2).to_pylist():
                try:
                    got.append(fetcher.fetch(url) if url else None)
                except OSError:
                    got.append(None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], ["source", "priority", "url", "content"])

    cols = candidates.selectExpr("cast(source AS string) source", "cast(priority AS int) priority", "cast(url AS string) url")
    return cols.mapInArrow(run, "source string, priority int, url string, content binary")


def translate(df: DataFrame, translator: Translator, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(id, content): a text that can't be translated is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for text in b.column(1).to_pylist():
                try:
                    got.append(translator.translate(text) if text else text)
                except (OSError, RuntimeError):
                    got.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.string())], ["id", "content"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("id"), df[text_col].alias("t")).mapInArrow(run, f"id {kind}, content string")


class Ocr(Protocol):
    def run(self, data: bytes, languages: str, timeout: float) -> tuple[int, bytes]: ...


#: Return codes of the OCR program: done; the file has text already and is kept as it is.
OCR_DONE, OCR_HAS_TEXT = 0, 6


def ocr(df: DataFrame, program: Ocr, languages: str, timeout: float = 1800) -> DataFrame:
    """(path, status, content): DONE, COPIED, FAILED or TIMEOUT; content is null for the last two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            status, out = [], []
            for data in b.column(1).to_pylist():
                try:
                    code, made = program.run(data, languages, timeout)
                except TimeoutError:
                    code, made = None, None
                name = {OCR_DONE: "DONE", OCR_HAS_TEXT: "COPIED", None: "TIMEOUT"}.get(code, "FAILED")
                status.append(name)
                out.append(made if name == "DONE" else data if name == "COPIED" else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(status), pa.array(out, pa.binary())], ["path", "status", "content"])

    return df.select("path", "content").mapInArrow(run, "path string, status string, content binary")
