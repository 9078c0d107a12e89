"""Byte-level vocabulary files."""

from __future__ import annotations

import json

import numpy as np

#: How byte-level BPE splits a text before it merges bytes.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The pieces of a byte-level vocabulary file as the bytes that they stand for, and its special strings."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    special = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
    pieces = {bytes(byte_of[c] for c in p): i for p, i in file["model"]["vocab"].items() if p not in special}
    return pieces, special


def encoder(path: str):
    """Text to ids (uint32), as the tokenizers library gives them without added special tokens, and the
    place of each id's first byte in the text's UTF-8.

    A plain byte-level BPE file, whose ids are in the order of the merges, is
    read by a quicker library with the same rules; any other by tokenizers.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    before = file.get("pre_tokenizer") or {}
    plain = (
        file["model"].get("type") == "BPE" and not file.get("normalizer") and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space") and before.get("use_regex", True) and not file["model"].get("dropout")
        and not file["model"].get("ignore_merges")
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in file.get("added_tokens", ()))
    )
    if plain:
        import tiktoken

        pieces, special = byte_level_vocabulary(path)
        merged = [m if isinstance(m, str) else " ".join(m) for m in file["model"]["merges"]]
        vocab = file["model"]["vocab"]
        if all(vocab[m.replace(" ", "", 1)] == 256 + i for i, m in enumerate(merged)):
            quick = tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=pieces, special_tokens=special)
            sizes = np.zeros(max([*pieces.values(), *special.values()]) + 1, np.int64)
            for piece, i in pieces.items():
                sizes[i] = len(piece)
            for string, i in special.items():
                sizes[i] = len(string.encode())

            def encode(text: str) -> tuple[np.ndarray, np.ndarray]:
                ids = quick.encode_to_numpy(text, allowed_special="all")
                own = sizes[ids]
                return ids, np.cumsum(own) - own

            return encode
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)

    def encode_slowly(text: str) -> tuple[np.ndarray, np.ndarray]:
        found = slow.encode(text, add_special_tokens=False)
        widths = np.array([0] + [len(c.encode("utf-8", "surrogatepass")) for c in text], np.int64)
        return np.array(found.ids, np.uint32), np.cumsum(widths)[[lo for lo, _ in found.offsets]].astype(np.int64) if found.ids else widths[:0]

    return encode_slowly
