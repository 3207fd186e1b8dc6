"""URL rules as globs that one bit-parallel automaton matches all at once.

A canonical URL is ``.host/path``. In a glob ``*`` stands for any run of characters without a slash, ``**`` for any run and
``?`` for one character other than a slash. Every literal or ``?`` of every glob is one bit of a row of 64-bit words. A step
of the simulation shifts all bits by one, keeps those whose character fits (Shift-And) and those that a wildcard lets stay.
A batch of URLs is stepped through together, character by character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.shared import code_points, ship

# Fixed values: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BLOCKED_GLOBS = ["*spam*/**", "*casino*/**", "*pills*/**", "**/wp-login.php", "**/cgi-bin/**"]
CELLS = 2_000_000


@dataclass
class Automaton:
    """Packed masks of a list of globs; ``fits`` tells which of them each text matches as a whole."""

    alphabet: np.ndarray  # sorted code points that the globs name; every other one is the class past the end
    fit: np.ndarray  # [class, word]: bits entered by that character
    stay: np.ndarray  # [class, word]: bits that a wildcard keeps on that character
    first: np.ndarray  # [word]: start bits
    last: list[tuple[int, int]]  # per glob: word and bit of its final state

    @classmethod
    def of(cls, globs: list[str]) -> Automaton:
        alphabet = np.array(sorted({ord(c) for glob in globs for c in glob if c not in "*?"} | {ord("/")}), dtype=np.uint32)
        place = {int(c): i for i, c in enumerate(alphabet)}
        states: list[tuple[str | None, str]] = []  # (character entered by, wildcard that stays)
        starts, last = [], []
        for glob in globs:
            starts.append(len(states))
            states.append((None, ""))
            for symbol in glob.replace("**", "\0"):
                if symbol in "*\0":
                    entered, wildcard = states[-1]
                    states[-1] = (entered, "**" if symbol == "\0" or wildcard == "**" else "*")
                else:
                    states.append((symbol, ""))
            last.append(divmod(len(states) - 1, 64))
        words = max(1, -(-len(states) // 64))
        fit = np.zeros((len(alphabet) + 1, words), dtype=np.uint64)
        stay, first = np.zeros_like(fit), np.zeros(words, dtype=np.uint64)
        slash = place[ord("/")]
        for i, (symbol, wildcard) in enumerate(states):
            word, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
            if symbol == "?":
                fit[:, word] |= bit
                fit[slash, word] &= ~bit
            elif symbol is not None:
                fit[place[ord(symbol)], word] |= bit
            if wildcard:
                stay[:, word] |= bit
                if wildcard == "*":
                    stay[slash, word] &= ~bit
        for i in starts:
            first[i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return cls(alphabet, fit, stay, first, last)

    def fits(self, texts: list[str]) -> np.ndarray:
        """[text, glob]: whether the whole text matches the glob. Texts of like length are stepped through together."""
        out = np.zeros((len(texts), len(self.last)), dtype=bool)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and len(texts[order[end]]) * (end + 1 - begin) <= CELLS:
                end += 1
            rows = order[begin:end]
            out[rows] = self._steps([texts[i] for i in rows])
            begin = end
        return out

    def _steps(self, texts: list[str]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts])
        classes = np.zeros((len(texts), int(lengths.max(initial=0))), dtype=np.int32)
        for i, text in enumerate(texts):
            codes = code_points(text)
            at = np.searchsorted(self.alphabet, codes)
            known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes
            classes[i, : len(codes)] = np.where(known, at, len(self.alphabet))
        state = np.tile(self.first, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for step in range(classes.shape[1]):
            # Shorter texts come first, so those that go on are a tail of the batch.
            on = int(np.searchsorted(lengths, step, side="right"))
            now = state[on:]
            shifted = now << one
            shifted[:, 1:] |= now[:, :-1] >> top
            kind = classes[on:, step]
            state[on:] = (shifted & self.fit[kind]) | (now & self.stay[kind])
        return np.stack([(state[:, word] >> np.uint64(bit)) & one != 0 for word, bit in self.last], axis=1)


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(url.isNull() | (at == 0), F.lit("")).otherwise(F.substr(url, at + 3))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, capital, small), path


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    blocked: list[str] = BLOCKED_GLOBS,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest rule whose host the URL's host is or is below, and whose path starts the URL's path, decides; among rules of
    one length the first. Without one ``rule`` is null and the verdict is ``block`` if any glob of ``blocked`` fits the
    canonical URL, else ``allow``. A URL that is null or has no ``://`` has an empty host and path, so it is allowed.

    The rules are few and known when the plan is built; the pages are judged where they are read.
    """
    ship(pages.sparkSession)
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = [f"*.{host}{path}**" for _, host, path in ordered] + blocked
    names = [host + path for _, host, path in ordered]
    verdicts = [verdict for verdict, _, _ in ordered]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.of(globs)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            fits = automaton.fits([f".{h}{p}" for h, p in zip(hosts, paths)])
            by_rule = fits[:, : len(names)]
            rule = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1) if names else 0, -1)
            bad = fits[:, len(names) :].any(axis=1)
            chosen = [names[r] if r >= 0 else None for r in rule]
            verdict = [verdicts[r] if r >= 0 else "block" if b else "allow" for r, b in zip(rule, bad)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chosen, pa.string()), pa.array(verdict, pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col("url"))
    frame = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return frame.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
