"""SimHash near-dedup against fingerprints from the xxhash library and links of all pairs."""

import random

import xxhash

from bourse.llm import simhash


def fingerprint(text, words):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, words):
    prints = [fingerprint(t, words) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 4:
                parent[find(a)] = find(b)
    least = {}
    for k, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(find(k))) for k, ((d, _, _), p) in enumerate(zip(rows, prints, strict=True))), key=repr)


def near_rows():
    rng = random.Random(13)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choice(vocabulary) for _ in range(400)]
    rows = []
    for k in range(30):
        text = list(base)
        for _ in range(k % 6):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((1000 + k, " ".join(text), "n"))
    return rows


def test_against_all_pairs(documents, edge_rows, words, rows):
    table = edge_rows + near_rows() + [(2000, "Alpha beta", "x"), (2001, "alpha beta", "x"), (2002, "ALPHA  BETA\n", "x")]
    assert rows(simhash.near_duplicates(documents(table))) == brute(table, words)


def test_every_word_decodes_to_the_nearest_codeword():
    rng = random.Random(3)
    codewords = set()
    for _ in range(300):
        word = rng.getrandbits(23)
        c = simhash.decode(word)
        assert simhash._syndrome(c) == 0 and bin(c ^ word).count("1") <= 3
        codewords.add(c)
    assert len(simhash.error_patterns()) == 1 + 23 + 253 + 1771 + 8855


def test_four_differing_bits_share_a_key(spark):
    """Pairs with four or fewer differing bits anywhere are linked; five are not."""
    rng = random.Random(4)
    base = rng.getrandbits(64) - (1 << 63)
    prints = [base]
    for k in range(1, 6):
        flipped = base
        for b in rng.sample(range(64), k):
            flipped ^= 1 << b
        prints.append(flipped if flipped < (1 << 63) else flipped - (1 << 64))
    found = {tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in prints], "fingerprint long")).collect()}
    assert {(min(base, p), max(base, p)) for p in prints[1:5]} <= found
    assert (min(base, prints[5]), max(base, prints[5])) not in found


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
