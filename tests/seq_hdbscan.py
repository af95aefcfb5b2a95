"""Independent sequential HDBSCAN for tests only (numpy, small N):
all-pairs mutual reachability -> Prim MST -> single-linkage dendrogram ->
condensed tree -> EOM/leaf selection -> labels.  Written from the published
algorithm description, sharing no code with the Spark implementation."""

from __future__ import annotations

import numpy as np


def mst_prim(w: np.ndarray):
    n = w.shape[0]
    in_tree = np.zeros(n, bool)
    best = np.full(n, np.inf)
    frm = np.full(n, -1)
    best[0] = 0
    edges = []
    for _ in range(n):
        cand = np.where(in_tree, np.inf, best)
        u = int(np.argmin(cand))
        in_tree[u] = True
        if frm[u] >= 0:
            edges.append((min(u, frm[u]), max(u, frm[u]), float(w[u, frm[u]])))
        upd = (~in_tree) & (w[u] < best)
        best[upd] = w[u][upd]
        frm[upd] = u
    return edges


def hdbscan_seq(x: np.ndarray, min_cluster_size: int, min_samples: int | None = None,
                method: str = "eom"):
    n = len(x)
    ms = min_samples or min_cluster_size
    d = np.sqrt(np.maximum(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1), 0))
    core = np.sort(d, axis=1)[:, ms - 1]
    w = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    edges = sorted(mst_prim(w), key=lambda e: (e[2], e[0], e[1]))
    # single linkage tree via union find
    parent = list(range(2 * n))
    size = [1] * n + [0] * n
    children = {}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a
    nxt = n
    for a, b, wt in edges:
        ra, rb = find(a), find(b)
        children[nxt] = (ra, rb, wt)
        size[nxt] = size[ra] + size[rb]
        parent[ra] = parent[rb] = nxt
        nxt += 1
    root = nxt - 1

    def leaves(node):
        out, st = [], [node]
        while st:
            v = st.pop()
            if v < n:
                out.append(v)
            else:
                st.extend(children[v][:2])
        return out
    # condensed tree
    clusters = {0: {"birth": 0.0, "parent": None, "stab": 0.0, "kids": [], "pts": []}}
    fall = {}  # point -> cluster it falls out of
    stack = [(root, 0)]
    while stack:
        node, cl = stack.pop()
        if node < n:
            fall[node] = cl
            continue
        l, r, wt = children[node]
        lam = 1.0 / wt if wt > 0 else 1e300
        big = [c for c in (l, r) if size[c] >= min_cluster_size]
        if len(big) == 2:
            for c in (l, r):
                cid = len(clusters)
                clusters[cid] = {"birth": lam, "parent": cl, "stab": 0.0, "kids": [], "pts": []}
                clusters[cl]["kids"].append(cid)
                clusters[cl]["stab"] += size[c] * (lam - clusters[cl]["birth"])
                stack.append((c, cid))
        else:
            for c in (l, r):
                if size[c] >= min_cluster_size:
                    stack.append((c, cl))
                else:
                    for p in leaves(c):
                        fall[p] = cl
                        clusters[cl]["stab"] += lam - clusters[cl]["birth"]
    ids = [c for c in clusters if c != 0]
    if method == "leaf":
        sel = {c for c in ids if not clusters[c]["kids"]}
    else:
        sel, sub = set(), {}
        for c in sorted(ids, reverse=True):
            ks = clusters[c]["kids"]
            s = sum(sub[k] for k in ks)
            if not ks or clusters[c]["stab"] >= s:
                sub[c] = clusters[c]["stab"]
                st = list(ks)
                while st:
                    k = st.pop()
                    sel.discard(k)
                    st.extend(clusters[k]["kids"])
                sel.add(c)
            else:
                sub[c] = s
    labels = np.full(n, -1)
    for p in range(n):
        c = fall.get(p, 0)
        while c is not None and c not in sel:
            c = clusters[c]["parent"]
        if c is not None:
            labels[p] = c
    # renumber by smallest member id
    uniq = sorted({l for l in labels if l != -1}, key=lambda c: int(np.min(np.where(labels == c)[0])))
    remap = {c: i for i, c in enumerate(uniq)}
    return np.array([remap.get(l, -1) for l in labels])
