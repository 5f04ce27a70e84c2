import random

from millrace.llm.minhash import _spanning, near_duplicates


def test_spanning_links_keep_the_groups(spark):
    rnd = random.Random(4)
    pairs = {(rnd.randint(0, 30), rnd.randint(31, 400)) for _ in range(3000)}
    left = {(r.a, r.b) for r in _spanning(spark.createDataFrame(list(pairs), "a bigint, b bigint")).collect()}

    def groups(links):
        top = list(range(401))

        def root(x):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in links:
            top[max(root(a), root(b))] = min(root(a), root(b))
        return [root(x) for x in range(401)]

    assert groups(left) == groups(pairs) and len(left) <= 370 + 31 * 30


def test_many_near_copies_with_different_hubs(spark):
    """Every copy differs from the others in a few words, so bands put them into many buckets."""
    rnd = random.Random(6)
    base = [f"word{rnd.randint(0, 5000)}" for _ in range(150)]
    rows = []
    for k in range(150):
        words = list(base)
        for at in rnd.sample(range(150), 2):
            words[at] = f"other{k}x{at}"
        rows.append((1000 - k, " ".join(words)))
    rows += [(k, " ".join(f"lone{k}n{i}" for i in range(40))) for k in range(50)]

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {k: shingles(t) for k, t in rows}
    label = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == label and len(links) > 1000
