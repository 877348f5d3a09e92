"""Plain versions of the operators, for small inputs."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    found = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for i in range(len(found) - 2):
        at[tuple(found[i : i + 3])].append(i)
    covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(3)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def grams(text, size=4):
    found = words((text or "").translate(LOWER))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def components(docs, percent=85):
    """Smallest reachable id per document of a list of (id, text)."""
    sets = [grams(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same_id = docs[i][0] == docs[j][0]
            if same_id or (a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j])):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return {doc: least[root(i)] for i, (doc, _) in enumerate(docs)}


def hits(text, items, size=10):
    """Words hit and items found in one text."""
    found, covered, names = plain(text), set(), set()
    for name, item in items:
        wanted = plain(item)
        for i in range(max(1, len(wanted) - size + 1)) if wanted else ():
            window = wanted[i : i + size]
            for j in range(len(found) - len(window) + 1):
                if found[j : j + len(window)] == window:
                    covered.update(range(j, j + len(window)))
                    names.add(name)
    return len(found), len(covered), sorted(names)


def near(text, items, size=10, slop=4):
    """Items of which the words of any window lie, in any order, within ``size + slop`` words."""
    found, names = plain(text), set()
    for name, item in items:
        wanted = plain(item)
        for i in range(max(1, len(wanted) - size + 1)) if wanted else ():
            window = wanted[i : i + size]
            span = len(window) + slop
            if any(set(window) <= set(found[j : j + span]) for j in range(len(found))):
                names.add(name)
    return sorted(names)
