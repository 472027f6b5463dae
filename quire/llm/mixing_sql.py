"""SQL for the mixture of :mod:`quire.llm.mixing`, written level by level."""

from __future__ import annotations

from quire.llm.mixing import LEVELS


def mixture_sql(weights: dict[str, int], domain: str, share: tuple[int, int], max_epochs: int, seed: str) -> str:
    """DuckDB SQL of ``select_mix`` over ``documents``; ``domain`` is an expression in SQL."""
    steps = [f"""own AS (
  SELECT doc_id, coalesce({domain}, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(sum(coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)) AS BIGINT) AS n_tokens
  FROM documents GROUP BY ALL),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM own GROUP BY ALL),
q0 AS (SELECT 0 AS root, CAST(coalesce(sum(tokens), 0) AS BIGINT) * {share[0]} // {share[1]} AS quota FROM leaves)"""]
    for depth, _ in enumerate(LEVELS):
        above = ["root", *LEVELS[:depth]]
        keys = [*above, LEVELS[depth]]
        path = " || '/' || ".join(LEVELS[: depth + 1])
        cases = "".join(f" WHEN {path} = '{k}' THEN {v}" for k, v in weights.items() if k.count("/") == depth)
        weight = f"CASE{cases} ELSE 1 END" if cases else "1"
        by = ", ".join(above)
        steps.append(f"""n{depth} AS (
  SELECT *, {weight} AS weight FROM
    (SELECT {", ".join(["0 AS root", *LEVELS[: depth + 1]])}, CAST(sum(tokens * {max_epochs}) AS BIGINT) AS supply FROM leaves GROUP BY ALL)
    JOIN (SELECT {by}, quota AS budget FROM q{depth}) USING ({by})),
r{depth} AS (
  SELECT *, coalesce(sum(supply) OVER (PARTITION BY {by} ORDER BY CASE WHEN weight > 0 THEN supply / weight END NULLS LAST, {LEVELS[depth]}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
    sum(weight) OVER (PARTITION BY {by} ORDER BY CASE WHEN weight > 0 THEN supply / weight END NULLS LAST, {LEVELS[depth]}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM n{depth}),
f{depth} AS (SELECT *, weight > 0 AND (budget - gone) * weight >= supply * rest AS used_up FROM r{depth}),
q{depth + 1} AS (
  SELECT {", ".join(keys)}, CAST(CASE WHEN used_up THEN supply WHEN open = 0 THEN 0 ELSE (budget - given) * weight // open END AS BIGINT) AS quota
  FROM (SELECT *, sum(CASE WHEN used_up THEN supply ELSE 0 END) OVER (PARTITION BY {by}) AS given,
      sum(CASE WHEN used_up THEN 0 ELSE weight END) OVER (PARTITION BY {by}) AS open FROM f{depth}))""")
    return f"""WITH {', '.join(steps)},
epochs AS (
  SELECT domain, lang, source, tokens, CAST(unnest(range(0, (quota - 1) // tokens + 1)) AS BIGINT) AS epoch, quota
  FROM q{len(LEVELS)} JOIN leaves USING (domain, lang, source) WHERE quota > 0),
ordered AS (
  SELECT doc_id, domain, lang, source, epoch, n_tokens, quota - epoch * tokens AS room,
    coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch
      ORDER BY md5('{seed}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM own JOIN epochs USING (domain, lang, source))
SELECT doc_id, domain, lang, source, epoch, n_tokens, CAST(least(n_tokens, room - before) AS BIGINT) AS n_taken
FROM ordered WHERE before < room OR room >= (SELECT tokens FROM leaves l WHERE l.domain = ordered.domain AND l.lang = ordered.lang AND l.source = ordered.source)"""
