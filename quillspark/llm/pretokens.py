"""Splitting text into the pieces that byte-level merges never cross.

The pattern begins a new piece at any space that is followed by something
other than white space.  So a text may be cut there into chunks (" word,"),
each chunk split by the pattern on its own, and the result is that of the whole
text.  Chunks repeat a lot, so whatever is known of a chunk is kept per chunk.
"""

from __future__ import annotations

import regex

#: Any white space after a space, or a space at the end: the plain cut would be wrong there.
_UNSAFE = regex.compile(r" (?=\s|$)")
_CUT = regex.compile(r" (?=\S)")


def chunks(text: str) -> list[str]:
    """Cut before each space that is followed by a non-space; joined they give the text."""
    if not text:
        return []
    if _UNSAFE.search(text) is None:
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + w for w in rest]
    starts = [0, *(m.start() for m in _CUT.finditer(text) if m.start()), len(text)]
    return [text[a:b] for a, b in zip(starts, starts[1:])]


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank per line."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def byte_letters() -> dict[str, int]:
    """The usual mapping of printable stand-in letters to bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_json_ranks(path: str) -> tuple[dict[bytes, int], dict[tuple[bytes, bytes], int], list[str]]:
    """Ids by token bytes, merge order by byte pair, and added tokens of a byte-level BPE file.

    The added tokens are those that the library finds inside texts by default.
    """
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    added = [t["content"] for t in spec.get("added_tokens", [])]
    ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    return ids, {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}, added
