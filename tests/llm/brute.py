"""Slow and plain versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    held, repeated = Counter(windows), set()
    for i, window in enumerate(windows):
        if held[window] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), len(set(words)),
    )


def shingle_set(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_components(texts, width, percent):
    """{doc_id: (set size, component)} of {doc_id: text}."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, members in sets.items():
        for shingle in members:
            holders[shingle].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, members in sets.items():
        for j, common in Counter(j for s in members for j in holders[s] if j > i).items():
            if 100 * common >= percent * (len(members) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeated_bytes(texts, length=100):
    """{doc_id: one flag for each byte} of {doc_id: text}; the flag says that the byte goes."""
    seen, flags = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        covered = bytearray(len(data))
        for start in range(len(data) - length + 1):
            string = data[start : start + length]
            if string in seen:
                covered[start : start + length] = b"\1" * length
            else:
                seen.add(string)
        flags[i] = covered
    return flags


def passage_row(text, covered):
    data = (text or "").encode()
    kept = bytes(b for b, gone in zip(data, covered, strict=True) if not gone)
    spans = sum(1 for k, gone in enumerate(covered) if gone and (k == 0 or not covered[k - 1]))
    return len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()


def cut_text(text, covered):
    """The text without the covered bytes; characters that are covered in part stay."""
    data, at, out = (text or "").encode(), 0, b""
    while at < len(data):
        end = at + 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if not all(covered[at:end]):
            out += data[at:end]
        at = end
    return out.decode()
