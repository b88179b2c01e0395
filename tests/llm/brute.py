"""Plain Python versions of the operators' contracts, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def quality_base(text):
    t = text or ""
    words = SPACE_WORD.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in (i, i + 1, i + 2)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def norm_lines(text):
    t = (text or "").translate(LOWER)
    t = re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[0-9]+", "0", t))
    return [x.strip(" ") for x in t.split("\n") if x.strip(" ")]


def quality_kept(rows, max_docs, max_share, min_left):
    """rows: (id, host, text) -> kept per row."""
    md5 = lambda s: hashlib.md5(s.encode()).digest()
    seen, hosts = {}, {}
    for _, host, text in rows:
        if lines := norm_lines(text):
            low = sorted(set(map(md5, lines)))
            hosts.setdefault(host, set()).add(low[0])
            for x in lines:
                seen.setdefault((host, x), set()).add((low[1:] or low)[0] if md5(x) == low[0] else low[0])
    out = []
    for _, host, text in rows:
        base = quality_base(text)
        gone = sum(
            len(x.split(" ")) for x in norm_lines(text)
            if len(seen[host, x]) > max_docs and len(seen[host, x]) > max_share * len(hosts[host])
        )
        out.append((gone, not base[5] and base[0] - gone >= min_left * base[0]))
    return out


def license_base(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        starts += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in starts]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in starts}))


def license_detections(text, rules):
    """Detections kept after suppression, by comparing every pair."""
    norm = " ".join(WORD.findall((text or "").translate(LOWER)))
    found = []
    for r in rules:
        if r.anchor in norm and r.keyword in norm:
            for m in re.finditer(f"(?<![^ ])(?:{r.regex})(?![^ ])", norm):
                a = norm[: m.start()].count(" ")
                found.append((a, -(a + m.group().count(" ")), r.priority, r.label, r.confidence, r.base))
    found.sort()
    kept = [
        x for k, x in enumerate(found)
        if not any(y[0] <= x[0] and y[1] <= x[1] and y[2] <= x[2] for y in found[:k])
    ]
    return found, kept


def contamination(text, items, window=13):
    words = WORD.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item_id, item in items:
        iw = WORD.findall((item or "").translate(LOWER))
        span = min(window, len(iw))
        wins = {tuple(iw[j : j + span]) for j in range(len(iw) - span + 1)} if iw else set()
        for i in range(len(words) - span + 1) if wins else ():
            if tuple(words[i : i + span]) in wins:
                hit.update(range(i, i + span))
                ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(words), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(words)
