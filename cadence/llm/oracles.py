"""DuckDB SQL for the queries of the newer operators, each by another route than
its operator: windows compared as strings, checksums as joins of byte
contributions, repairs as a recursion over whole audit strings."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT n, i, array_to_string(w[i:i + 34], ' ') AS sequence
  FROM (SELECT n, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
repeated AS (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1),
gone AS (SELECT DISTINCT n, unnest(range(i, i + 35)) AS j FROM windows JOIN repeated USING (sequence)),
words AS (SELECT n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT n, string_agg(word, ' ' ORDER BY j) AS text FROM words ANTI JOIN gone USING (n, j) GROUP BY n),
lost AS (SELECT n, count(*) AS n_removed FROM gone GROUP BY n)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(lost.n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (n) LEFT JOIN lost USING (n)
"""


def _crc32(keys: str) -> str:
    """CTEs up to ``crc(f, crc)``, the CRC-32 of each text ``f`` of the CTE ``keys``."""
    return f"""
bits(b, k, c) AS (
  SELECT b, 0, b FROM range(256) AS t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
byte(b, c) AS (SELECT b, c FROM bits WHERE k = 8),
longest(n) AS (SELECT coalesce(max(strlen(f)), 0) FROM {keys}),
contribution(d, b, c) AS (
  SELECT 0, b, c FROM byte
  UNION ALL SELECT p.d + 1, p.b, xor(p.c >> 8, byte.c)
  FROM contribution p JOIN byte ON byte.b = p.c & 255, longest WHERE p.d + 1 < longest.n),
started(n, c) AS (
  SELECT 0, 4294967295::BIGINT
  UNION ALL SELECT s.n + 1, xor(s.c >> 8, byte.c) FROM started s JOIN byte ON byte.b = s.c & 255, longest
  WHERE s.n < longest.n),
byte_of AS (
  SELECT f, strlen(f) - 1 - i AS d,
         16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1 AS b
  FROM (SELECT f, hex(f) AS h, unnest(range(strlen(f))) AS i FROM {keys})),
crc(f, crc) AS (
  SELECT x.f, xor(xor(x.c, started.c), 4294967295)
  FROM (SELECT f, bit_xor(c) AS c FROM byte_of JOIN contribution USING (d, b) GROUP BY f) x
  JOIN started ON started.n = strlen(x.f))"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_FEATURE_WORD}')"

OP12_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS n, 1 AS own, doc_id, {_WORDS} AS w FROM documents
  UNION ALL SELECT -row_number() OVER (), 0, NULL, {_WORDS} FROM benchmark),
runs AS (SELECT n, own, w, unnest([1, 2, 3]) AS size FROM texts),
features AS (
  SELECT n, own, array_to_string(w[i:i + size - 1], ' ') AS f
  FROM (SELECT n, own, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM runs WHERE len(w) >= size)),
found AS (SELECT n, own, f, count(*) AS times FROM features GROUP BY ALL),
keys AS (SELECT DISTINCT f FROM found),
{_crc32("keys")},
hashed AS (SELECT found.n, found.own, crc.crc % 10000 AS bucket, found.times FROM found JOIN crc USING (f)),
total AS (
  SELECT coalesce(sum(times) FILTER (own = 1), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (own = 0), 0)::DOUBLE AS t FROM hashed),
gain AS (
  SELECT bucket, floor(1000 * ln((b.t + 1) * (total.s + 10000) / ((b.s + 1) * (total.t + 10000))))::BIGINT AS gain
  FROM (SELECT bucket, coalesce(sum(times) FILTER (own = 1), 0)::DOUBLE AS s,
               coalesce(sum(times) FILTER (own = 0), 0)::DOUBLE AS t FROM hashed GROUP BY bucket) b, total),
weights AS (
  SELECT n, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS weight
  FROM hashed JOIN gain USING (bucket) WHERE own = 1 GROUP BY n),
scored AS (
  SELECT texts.n, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (n) WHERE own = 1),
ranked AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n) AS rank, count(*) OVER () AS many
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * many // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (n)
"""


def _repair() -> str:
    far = "{'c': 1000000000::BIGINT, 'a': '', 'r': ''}"

    def line(role: str, text: str) -> str:
        return f"chr(10) || {role} || ':' || {text}"

    def go(state: str, cost: str, edit: str, added: str, allowed: str = "true") -> str:
        return (
            f"CASE WHEN {allowed} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'r': {state}.r || {added}}}"
            f" ELSE {far} END"
        )

    def stay(state: str, initial: str) -> str:
        return go(state, "x.cost_on", "K", line("x.role", "x.text"), f"NOT x.must_go AND x.initial = '{initial}'")

    def change(state: str, role: str) -> str:
        return go(state, "1 + x.cost_on", "R", line(f"'{role}'", "x.text"), "NOT x.must_go")

    def put(state: str, role: str) -> str:
        return go(state, "5", "I", line(f"'{role}'", "''"))

    def drop(state: str) -> str:
        return go(state, "2", "D", "''")

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    return f"""
step(g, k, e, s, u, a) AS (
  SELECT g, 0, {{'c': 0::BIGINT, 'a': '', 'r': ''}}, {far}, {{'c': 5::BIGINT, 'a': 'I', 'r': {line("'user'", "''")}}},
         {{'c': 10::BIGINT, 'a': 'II', 'r': {line("'user'", "''")} || {line("'assistant'", "''")}}}
  FROM conversation
  UNION ALL
  SELECT g, k, e, s, u, {least("a", put("u", "assistant"))} FROM (
    SELECT g, k, e, s, a, {least("u", put("e", "user"), put("s", "user"), put("a", "user"))} AS u FROM (
      SELECT step.g, x.k, {drop("e")} AS e, {least(drop("s"), stay("e", "s"))} AS s,
             {least(drop("u"), *[f(v, *p) for v in "esa" for f, p in ((stay, ("u",)), (change, ("user",)))])} AS u,
             {least(drop("a"), stay("u", "a"), change("u", "assistant"))} AS a
      FROM step JOIN x ON x.g = step.g AND x.k = step.k + 1))),
done AS (SELECT step.g, {least("e", "a")} AS best FROM step JOIN conversation c ON c.g = step.g AND c.rows = step.k)"""


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP13_SQL = f"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS f
  FROM conversations),
keys AS (SELECT DISTINCT f FROM plain),
{_crc32("keys")},
faulty AS (SELECT plain.*, crc.crc % 20 AS fault FROM plain JOIN crc USING (f)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM faulty WHERE fault <> 0),
placed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, *
  FROM (SELECT conv_id, turn, role, text FROM damaged UNION ALL
        SELECT DISTINCT conv_id, NULL, NULL, NULL FROM conversations)),
seen AS (
  SELECT g, conv_id, turn, role, text, substr(role, 1, 1) AS initial, rtrim(text, {_WHITE}) AS body,
         row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS k,
         row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST) AS nth
  FROM placed WHERE role IS NOT NULL),
judged AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS kind,
         lag(initial) OVER (PARTITION BY g ORDER BY k) || initial AS pair
  FROM seen),
conversation AS (
  SELECT p.g, any_value(p.conv_id) AS conv_id, any_value(coalesce(j.rows, 0)) AS rows FROM placed p
  LEFT JOIN (SELECT g, count(*) AS rows FROM judged GROUP BY g) j USING (g) GROUP BY p.g),
x AS (
  SELECT g, k, role, text, initial, coalesce(kind IN ('blank', 'duplicate'), false) AS must_go,
         CASE WHEN kind = 'truncated' THEN 5 ELSE 0 END AS cost_on
  FROM judged),
{_repair()},
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
         count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (k > 1 AND coalesce(pair, '') NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY g)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, done.best.c AS cost, done.best.a AS audit,
       sha256(substr(done.best.r, 2)) AS repaired_sha256
FROM conversation c JOIN done USING (g) LEFT JOIN counts USING (g)
"""

ORACLE_SQL = {
    "op11_substring_dedup": OP11_SQL,
    "op12_importance": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
