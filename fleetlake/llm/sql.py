"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations


def weight_case(levels: list[str], weights: dict[tuple[str, ...], int]) -> str:
    cases = []
    for path, weight in sorted(k for k in weights.items() if len(k[0]) == len(levels)):
        on = [f"{level} = '{name}'" for level, name in zip(levels, path) if name != "*"]
        cases.append(f"WHEN {' AND '.join(on) or 'true'} THEN {weight}")
    return f"CASE {' '.join(cases)} ELSE 1 END" if cases else "1"


def mixing(
    levels: dict[str, str],
    weights: dict[tuple[str, ...], int],
    budget_share: float,
    max_epochs: int,
    seed: int,
    table: str = "documents",
) -> str:
    """One sorted pass per leaf, where the operator searches by digits."""
    path = list(levels)
    keys = ", ".join(path)
    steps = [
        "t AS (SELECT doc_id, "
        + ", ".join(f"coalesce({expr}, '') AS {name}" for name, expr in levels.items())
        + ", CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS HUGEINT) AS n"
        + f" FROM {table})",
        f"leaves AS (SELECT {keys}, sum(n) AS size, CASE WHEN "
        + " OR ".join(f"{weight_case(path[:depth], weights)} = 0" for depth in range(1, len(path) + 1))
        + f" THEN 0 ELSE sum(n) END AS open_size FROM t GROUP BY {keys})",
        f"b0 AS (SELECT *, least(sum(size) OVER () * {round(budget_share * 1000)} // 1000,"
        f" sum(open_size) OVER () * {max_epochs}) AS budget FROM leaves)",
    ]
    for depth in range(1, len(path) + 1):
        at, parent, name = ", ".join(path[:depth]), ", ".join(path[: depth - 1]), path[depth - 1]
        by = f"PARTITION BY {parent}" if parent else ""
        steps += [
            f"n{depth} AS (SELECT {at}, sum(open_size) * {max_epochs} AS cap, any_value(budget) AS budget,"
            f" CAST({weight_case(path[:depth], weights)} AS HUGEINT) AS w FROM b{depth - 1} GROUP BY {at})",
            f"o{depth} AS (SELECT *, sum(w) OVER ({by}) AS all_w,"
            f" coalesce(sum(cap) OVER before, 0) AS before_cap, coalesce(sum(w) OVER before, 0) AS before_w"
            f" FROM n{depth} WINDOW before AS ({by} ORDER BY cap * 1000000 // greatest(w, 1), {name}"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
            f"f{depth} AS (SELECT *, cap * (all_w - before_w) <= (budget - before_cap) * w AS is_full FROM o{depth})",
            f"s{depth} AS (SELECT {at}, CASE WHEN is_full THEN cap ELSE greatest(0,"
            f" (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({by})) * w"
            f" // greatest(1, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({by}))) END AS share FROM f{depth})",
            f"b{depth} AS (SELECT {keys}, size, open_size, share AS budget FROM b{depth - 1} JOIN s{depth} USING ({at}))",
        ]
    last = f"b{len(path)}"
    steps.append(
        f"keyed AS (SELECT t.*, size, budget, budget // greatest(size, 1) AS epochs,"
        f" budget % greatest(size, 1) AS left_over,"
        f" CAST('0x' || substr(md5('{seed}|' || CAST(budget // greatest(size, 1) AS VARCHAR) || '|'"
        f" || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS key FROM t JOIN {last} USING ({keys}))"
    )
    steps.append(f"run AS (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY key, doc_id NULLS FIRST) AS so_far FROM keyed)")
    return (
        "WITH "
        + ",\n".join(steps)
        + f"\nSELECT doc_id, {keys}, CAST(n AS BIGINT) AS n_tokens, CAST(size AS BIGINT) AS leaf_tokens,"
        " CAST(budget AS BIGINT) AS leaf_target,"
        " CAST(epochs + CASE WHEN left_over > 0 AND so_far <= left_over THEN 1 ELSE 0 END AS BIGINT) AS copies FROM run"
    )


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
EXACT_DUPLICATES = f"""
WITH t AS (SELECT doc_id, {_LOWERED} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""

REPEATS = """
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS k
        FROM t, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT k, min(doc_id) AS first FROM win GROUP BY k) USING (k)
        WHERE doc_id > first),
gone AS (SELECT doc_id, list(DISTINCT i + j) AS places FROM hit, range(13) r(j) GROUP BY doc_id),
kept AS (SELECT doc_id, w, coalesce(len(places), 0) AS n_removed,
                list_filter(w, lambda x, p: NOT list_contains(coalesce(places, []), p)) AS k
         FROM t LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
"""

FILL_IN_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT doc_id, text, u, len(u) AS n,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
             CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%' THEN 'plain'
                  WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT doc_id, text, n, form,
             coalesce(array_to_string(list_slice(u, 1, least(a, b)), ''), '') AS prefix,
             coalesce(array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), ''), '') AS middle,
             coalesce(array_to_string(list_slice(u, greatest(a, b) + 1, n), ''), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


def clustering(k: int = 40, rounds: int = 5, seed: int = 2, dimensions: int = 64, table: str = "embeddings") -> str:
    """All distances in every round, where the operator searches."""
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x:"
        f" CAST(greatest(-4194304, least(4194304, floor(256 * CAST(x AS DOUBLE)))) AS BIGINT)) AS v FROM {table}"
        f" WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL"
        f" AND isfinite(CAST(x AS DOUBLE)))) = {dimensions})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c FROM"
        f" (SELECT v, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, v LIMIT {k}))",
    ]
    distance = (
        f"CAST(list_sum(list_transform(range(1, {dimensions + 1}), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT)"
    )
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v,"
            f" min(struct_pack(d := {distance}, k := cluster)) AS best"
            f" FROM (SELECT *, row_number() OVER () AS row FROM v) CROSS JOIN c{r} GROUP BY row)"
        )
        if r < rounds:
            # Division rounds towards zero, so the remainder is taken off first.
            steps.append(
                f"s{r} AS (SELECT best.k AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{r},"
                f" range(1, {dimensions + 1}) r(i) GROUP BY ALL)"
            )
            steps.append(
                f"m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{r} GROUP BY cluster)"
            )
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"\nSELECT vec_id, cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY cluster) AS BIGINT)"
        " AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ','))"
        f" AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON cluster = best.k"
    )
