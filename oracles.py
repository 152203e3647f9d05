"""The registered queries again as plain SQL over the given tables, for comparison.

Written as joins, windows and recursion over one row per vertex, point or piece, quite
unlike the array columns of the package. Named parts are put together on demand.
"""

from __future__ import annotations

import re

A, E2 = "6378137e0", "0.0066943799901413165e0"
Q = f"(1e0 - {E2} * pow(sin(radians((y + y2) / 2e0)), 2e0))"
SIN, COS = "sin(radians((y + y2) / 2e0))", "cos(radians((y + y2) / 2e0))"
METRES = (
    f"sqrt(pow({A} * (1e0 - {E2}) / pow({Q}, 1.5e0) * radians(y2 - y), 2e0)"
    f" + pow({A} / sqrt({Q}) * {COS} * radians(x2 - x), 2e0))"
)
BEND_X = f"2e0 * (1e0 - {E2}) * {SIN} / ({Q} * {COS}) * (y2 - y) * radians(x2 - x)"
BEND_Y = (
    f"(-3e0 * {E2} * {SIN} * {COS} / {Q} * (y2 - y) * radians(y2 - y)"
    f" - {SIN} * {COS} * {Q} / (1e0 - {E2}) * (x2 - x) * radians(x2 - x))"
)

PARTS = {
    "v": """SELECT l_orderkey AS seg, l_suppkey AS node, l_partkey, l_returnflag AS flag,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
            l_extendedprice, l_discount, l_tax, l_returnflag) - 1 AS idx,
        -122e0 + (l_suppkey % 100) * 9e-5 AS x, 47e0 + (l_suppkey % 31) * 1e-4 AS y,
        l_discount + 0e0 AS lo, l_discount + 0e0 + 3e-1 + l_tax AS hi FROM lineitem""",
    "net": "SELECT seg, count(*) AS n, max(idx) AS last_idx FROM v GROUP BY seg HAVING count(DISTINCT node) >= 2",
    "vv": "SELECT v.*, n, last_idx FROM v JOIN net USING (seg)",
    "e": """SELECT seg, idx, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM vv
        WINDOW w AS (PARTITION BY seg ORDER BY idx)""",
    "em": f"SELECT *, {METRES} AS m FROM e WHERE x2 IS NOT NULL",
    "run": """SELECT vv.seg, vv.idx, vv.x, vv.y, last_idx, coalesce(sum(m) OVER (PARTITION BY vv.seg ORDER BY vv.idx
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS at_m
        FROM vv LEFT JOIN em ON em.seg = vv.seg AND em.idx = vv.idx""",
    "tot": "SELECT seg, at_m AS total FROM run WHERE idx = last_idx",
    "con": """SELECT s_suppkey AS node, concat('n', s_suppkey) AS cid, -122e0 + (s_suppkey % 100) * 9e-5 AS x,
        47e0 + (s_suppkey % 31) * 1e-4 AS y FROM supplier WHERE s_suppkey % 7 <> 3""",
    "pairs": """SELECT vv.seg, vv.idx, node, concat('n', node) AS cid, at_m / total AS spot, vv.last_idx,
        row_number() OVER (PARTITION BY vv.seg ORDER BY vv.idx) - 1 AS ci
        FROM vv JOIN run ON run.seg = vv.seg AND run.idx = vv.idx JOIN tot ON tot.seg = vv.seg
        WHERE vv.idx = 0 OR vv.idx = vv.last_idx OR l_partkey % 3 = 0""",
    "loc": "SELECT p.*, con.x, con.y FROM pairs p LEFT JOIN con USING (node)",
    "usable": "SELECT *, ci = max(ci) OVER (PARTITION BY seg) AS is_last FROM loc WHERE x IS NOT NULL",
    "first_at": """SELECT u.seg, u.ci, min(r.idx) AS vertex FROM usable u
        JOIN run r ON r.seg = u.seg AND r.x = u.x AND r.y = u.y GROUP BY u.seg, u.ci""",
    "placed0": """SELECT u.seg, u.ci, u.cid, u.x, u.y, u.is_last AND r.idx IS NOT NULL AS at_end, u.last_idx, f.vertex
        FROM usable u JOIN first_at f ON f.seg = u.seg AND f.ci = u.ci
        LEFT JOIN run r ON r.seg = u.seg AND r.idx = u.last_idx AND r.x = u.x AND r.y = u.y""",
    "placed": """SELECT p.seg, p.cid, p.x, p.y, CASE WHEN at_end THEN 1e0 ELSE at_m / total END AS lr,
        CASE WHEN at_end THEN total ELSE at_m END AS m, CASE WHEN at_end THEN p.last_idx ELSE p.vertex END AS vertex,
        row_number() OVER (PARTITION BY p.seg ORDER BY at_end DESC, p.vertex, ci) AS seq
        FROM placed0 p JOIN tot ON tot.seg = p.seg JOIN run r ON r.seg = p.seg AND r.idx = p.vertex""",
    "ends_of": """SELECT *, row_number() OVER (PARTITION BY seg ORDER BY lr, seq) AS up,
        row_number() OVER (PARTITION BY seg ORDER BY lr DESC, seq DESC) AS down FROM placed""",
    # Kept in line order, so that the far end counts as the one found last.
    "outer_placed": "SELECT * EXCLUDE (seq, up, down), up AS seq FROM ends_of WHERE up = 1 OR down = 1",
    "rules": """SELECT seg, row_number() OVER (PARTITION BY seg ORDER BY idx) - 1 AS ri, flag AS value, lo, hi
        FROM vv WHERE l_partkey % 2 = 0""",
    "names": "SELECT DISTINCT seg, cid FROM pairs",
    "met": """SELECT a.seg, min(a.cid) AS meet FROM names a JOIN names b ON b.seg = a.seg + 1 AND b.cid = a.cid
        GROUP BY a.seg""",
    "turn": """SELECT m.seg, m.meet AS c1, CASE WHEN m.seg % 5 = 0 THEN n.meet END AS c2,
        CASE m.seg % 3 WHEN 0 THEN 'forward' WHEN 1 THEN 'backward' END AS heading,
        CASE m.seg % 2 WHEN 0 THEN 'forward' ELSE 'backward' END AS final_heading, p.cid AS to_cid
        FROM met m LEFT JOIN met n ON n.seg = m.seg + 1 JOIN pairs p ON p.seg = m.seg + 1 AND p.ci = 0""",
    "lrv": """SELECT DISTINCT seg, lr FROM (SELECT seg, lo AS lr FROM rules UNION ALL SELECT seg, hi FROM rules
        UNION ALL SELECT seg, unnest([0e0, 1e0]) FROM (SELECT seg FROM rules UNION SELECT seg FROM met))
        WHERE lr <> 0 OR seg IN (SELECT seg FROM rules UNION SELECT seg FROM met)""",
    "cand0": """SELECT l.seg, l.lr, any_value(total) AS total, any_value(r.last_idx) AS last_idx,
        row_number() OVER (PARTITION BY l.seg ORDER BY l.lr) AS k,
        least(count(*) FILTER (WHERE r.idx > 0 AND l.lr * total - at_m > 5e-7), any_value(r.last_idx) - 1) AS vertex
        FROM lrv l JOIN tot ON tot.seg = l.seg JOIN run r ON r.seg = l.seg GROUP BY l.seg, l.lr""",
    "cand1": """SELECT c.seg, c.lr, c.total, c.k, c.vertex, x, y, x2, y2,
        CASE WHEN em.m > 0 THEN least((c.lr * c.total - at_m) / em.m, 1e0) ELSE 0e0 END AS t
        FROM cand0 c JOIN em ON em.seg = c.seg AND em.idx = c.vertex
        JOIN (SELECT seg, idx, at_m FROM run) r ON r.seg = c.seg AND r.idx = c.vertex""",
    "cand": f"""SELECT seg, lr, total, k, vertex,
        round(x + t * (x2 - x + (t - 1e0) / 2e0 * {BEND_X}), 7) AS px,
        round(y + t * (y2 - y + (t - 1e0) / 2e0 * {BEND_Y}), 7) AS py FROM cand1""",
    "cand_near": """SELECT c.seg, c.lr, any_value(c.total) AS total, any_value(k) AS k, any_value(c.vertex) AS vertex,
        any_value(px) AS px, any_value(py) AS py, min(abs(c.lr - p.lr)) AS near
        FROM cand c LEFT JOIN {placed} p ON p.seg = c.seg GROUP BY c.seg, c.lr""",
    "fold": """SELECT seg, 0::BIGINT AS k, NULL::DOUBLE AS last_lr, NULL::DOUBLE AS lr, NULL::BIGINT AS vertex,
            p.x AS lx, p.y AS ly, false AS take, NULL::DOUBLE AS total
        FROM (SELECT DISTINCT seg FROM lrv) s LEFT JOIN (SELECT seg, arg_max(x, seq) AS x, arg_max(y, seq) AS y
            FROM {placed} GROUP BY seg) p USING (seg)
        UNION ALL
        SELECT seg, k, CASE WHEN take THEN lr ELSE last_lr END, lr, vertex, CASE WHEN take THEN px ELSE lx END,
            CASE WHEN take THEN py ELSE ly END, take, total
        FROM (SELECT c.*, f.last_lr, f.lx, f.ly,
            coalesce(least(near, c.lr - f.last_lr) * c.total > 0.01, true) AND
            coalesce(px <> lx OR py <> ly, true) AS take
            FROM fold f JOIN cand_near c ON c.seg = f.seg AND c.k = f.k + 1)""",
    "added": """SELECT seg, concat(seg, '@', CASE lr WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE lr::VARCHAR END) AS cid,
        lx AS x, ly AS y, lr, lr * total AS m, vertex, 1000000 + k AS seq FROM fold WHERE take""",
    "pts": """SELECT seg, cid, x, y, lr, m, vertex, seq, false AS is_added FROM {placed} UNION ALL
        SELECT seg, cid, x, y, lr, m, vertex, seq, true FROM added""",
    "pc0": """SELECT seg, rn, cid AS s_id, x AS sx, y AS sy, lr AS s_lr, m AS s_m, vertex AS s_v, lead(cid) OVER w AS e_id,
        lead(x) OVER w AS ex, lead(y) OVER w AS ey, lead(lr) OVER w AS e_lr, lead(m) OVER w AS e_m,
        lead(vertex) OVER w AS e_v, count(*) OVER (PARTITION BY seg) AS np FROM
        (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY lr, seq) AS rn FROM pts)
        WINDOW w AS (PARTITION BY seg ORDER BY rn)""",
    "pc1": "SELECT *, np = 2 AND s_lr = 0 AND e_lr = 1 AS whole FROM pc0 WHERE e_lr IS NOT NULL",
    "pcv0": """SELECT seg, rn, whole, -1 AS ord, sx AS x, sy AS y FROM pc1 WHERE NOT whole UNION ALL
        SELECT seg, rn, whole, 1000000000, ex, ey FROM pc1 WHERE NOT whole UNION ALL
        SELECT p.seg, rn, whole, r.idx, r.x, r.y FROM pc1 p JOIN run r ON r.seg = p.seg
            AND (whole OR (r.idx > s_v AND r.idx <= e_v))""",
    "pcv1": """SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM pcv0
        WINDOW w AS (PARTITION BY seg, rn ORDER BY ord)""",
    "pcv2": """SELECT seg, rn, whole, x, y, row_number() OVER (PARTITION BY seg, rn ORDER BY ord) - 1 AS n,
        count(*) OVER (PARTITION BY seg, rn) AS cnt FROM pcv1 WHERE whole OR px IS NULL OR x <> px OR y <> py""",
    "ends": """SELECT seg, rn, arg_min(x, n) AS x1, arg_min(y, n) AS y1, arg_max(x, n) AS x9, arg_max(y, n) AS y9
        FROM pcv2 WHERE cnt > 1 GROUP BY seg, rn""",
    "fail": """SELECT net.seg, CASE WHEN coalesce(np, 0) < 2 THEN 'fewer than two split points'
            ELSE 'piece starts and ends in the same point' END AS reason
        FROM net LEFT JOIN (SELECT seg, count(*) AS np FROM pts GROUP BY seg) USING (seg)
        WHERE coalesce(np, 0) < 2 OR seg IN (SELECT seg FROM ends WHERE x1 = x9 AND y1 = y9) {more_fail}""",
    "piece": """SELECT pc1.*, row_number() OVER (PARTITION BY pc1.seg ORDER BY pc1.rn) - 1 AS piece_no
        FROM pc1 JOIN ends USING (seg, rn) WHERE pc1.seg NOT IN (SELECT seg FROM fail)""",
    "piece_v": "SELECT p.seg, piece_no, n, c.x, c.y FROM pcv2 c JOIN piece p ON p.seg = c.seg AND p.rn = c.rn",
    "piece_m": f"""SELECT seg, piece_no, sum({METRES}) AS m FROM (SELECT seg, piece_no, x, y, lead(x) OVER w AS x2,
        lead(y) OVER w AS y2 FROM piece_v WINDOW w AS (PARTITION BY seg, piece_no ORDER BY n)) WHERE x2 IS NOT NULL
        GROUP BY seg, piece_no""",
    "pcon": """SELECT seg, piece_no, cid, round((lr * total - s_m) / (e_m - s_m), 9) AS spot,
        row_number() OVER (PARTITION BY seg, piece_no ORDER BY lr, rank) - 1 AS pos,
        count(*) OVER (PARTITION BY seg, piece_no) AS cnt FROM (
        SELECT seg, piece_no, s_m, e_m, s_id AS cid, s_lr AS lr, 0 AS rank FROM piece UNION ALL
        SELECT seg, piece_no, s_m, e_m, e_id, e_lr, 1 FROM piece UNION ALL
        SELECT p.seg, piece_no, s_m, e_m, c.cid, c.spot, c.ci + 2 FROM piece p JOIN pairs c ON c.seg = p.seg
            AND c.spot > s_lr AND c.spot < e_lr AND c.cid <> s_id AND c.cid <> e_id) JOIN tot USING (seg)""",
    "two": """SELECT a.seg, a.piece_no, a.cid AS c0, b.cid AS c1 FROM pcon a JOIN pcon b
        ON b.seg = a.seg AND b.piece_no = a.piece_no AND b.pos = 1 WHERE a.pos = 0 AND a.cnt = 2""",
    "ptrn": """SELECT t.*, two.piece_no FROM turn t JOIN two ON two.seg = t.seg AND (
        (heading = 'forward' AND two.c1 = t.c1) OR (heading = 'backward' AND two.c0 = t.c1) OR
        (heading IS NULL AND (two.c0 = t.c1 OR two.c1 = t.c1)))""",
    "titem": """SELECT seg, piece_no, 0::BIGINT AS step, seg + 1 AS ref, c1 AS cid, c2 AS next_cid, final_heading FROM ptrn UNION ALL
        SELECT seg, piece_no, 1::BIGINT, seg + 2, c2, NULL, final_heading FROM ptrn WHERE c2 IS NOT NULL""",
    "ditem": """SELECT seg, piece_no, seg + 1 AS ref, to_cid AS cid, final_heading, c1 FROM ptrn WHERE heading IS NOT NULL""",
    "tmatch": """SELECT t.seg, t.piece_no, t.step, p.piece_no AS ref_piece, p.s_lr, p.e_lr FROM titem t
        JOIN piece p ON p.seg = t.ref WHERE CASE WHEN next_cid IS NULL THEN EXISTS (SELECT 1 FROM pcon c WHERE c.seg = p.seg
            AND c.piece_no = p.piece_no AND c.cid = t.cid AND c.pos = CASE final_heading WHEN 'forward' THEN 0 ELSE 1 END)
        ELSE EXISTS (SELECT 1 FROM pcon c WHERE c.seg = p.seg AND c.piece_no = p.piece_no AND c.cid = t.cid)
            AND EXISTS (SELECT 1 FROM pcon c WHERE c.seg = p.seg AND c.piece_no = p.piece_no AND c.cid = t.next_cid) END""",
    "tbest": "SELECT seg, piece_no, step, min(s_lr) AS s_lr, arg_min(e_lr, s_lr) AS e_lr FROM tmatch GROUP BY ALL",
    "tdone": """SELECT b.* FROM tbest b JOIN (SELECT seg, piece_no, count(*) AS found FROM tbest GROUP BY ALL) f
        USING (seg, piece_no) JOIN ptrn p USING (seg, piece_no)
        WHERE found = CASE WHEN c2 IS NULL THEN 1 ELSE 2 END""",
    "dmatch": """SELECT d.seg, d.piece_no, d.ref, d.cid, d.c1, p.s_lr, p.e_lr FROM ditem d JOIN piece p ON p.seg = d.ref
        JOIN pcon c ON c.seg = p.seg AND c.piece_no = p.piece_no AND c.cid = d.cid
            AND c.pos = CASE final_heading WHEN 'forward' THEN 0 ELSE 1 END""",
    "scoped": """SELECT seg, piece_no, ri, value, b - a >= 0.01 AS applies,
        CASE WHEN b - a >= 0.01 AND len - (b - a) >= 0.01 THEN a / len END AS lo,
        CASE WHEN b - a >= 0.01 AND len - (b - a) >= 0.01 THEN b / len END AS hi FROM (
        SELECT p.seg, piece_no, ri, value, e_m - s_m AS len, greatest(lo * total - s_m, 0e0) AS a,
            least(CASE WHEN hi = 0 THEN 1e0 ELSE hi END * total - s_m, e_m - s_m) AS b
        FROM piece p JOIN rules r ON r.seg = p.seg JOIN tot ON tot.seg = p.seg)""",
    "dv": """SELECT seg, row_number() OVER (PARTITION BY seg ORDER BY idx) - 1 AS i, x, y FROM (SELECT *, lag(x) OVER w AS px,
        lag(y) OVER w AS py FROM {shape} WINDOW w AS (PARTITION BY seg ORDER BY idx)) WHERE px IS NULL OR x <> px OR y <> py""",
    "de": """SELECT seg, i, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS \"by\", max(i) OVER (PARTITION BY seg) AS n,
        first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM dv WINDOW w AS (PARTITION BY seg ORDER BY i)""",
    "crossed": """SELECT DISTINCT seg FROM (SELECT a.seg, a.i, b.i AS j, a.n, a.ax, a.ay, a.bx, a.by, b.ax AS cx, b.ay AS cy,
            b.bx AS dx, b.by AS dy FROM de a JOIN de b ON a.seg = b.seg AND a.i < b.i WHERE a.bx IS NOT NULL AND b.bx IS NOT NULL)
        WHERE CASE WHEN j = i + 1 THEN (ax - bx) * (dy - \"by\") - (ay - \"by\") * (dx - bx) = 0
                AND (ax - bx) * (dx - bx) + (ay - \"by\") * (dy - \"by\") > 0
            WHEN i = 0 AND j = n - 1 AND dx = ax AND dy = ay THEN (bx - ax) * (cy - ay) - (\"by\" - ay) * (cx - ax) = 0
                AND (bx - ax) * (cx - ax) + (\"by\" - ay) * (cy - ay) > 0
            ELSE greatest(ax, bx) >= least(cx, dx) AND greatest(cx, dx) >= least(ax, bx)
                AND greatest(ay, \"by\") >= least(cy, dy) AND greatest(cy, dy) >= least(ay, \"by\")
                AND sign((bx - ax) * (cy - ay) - (\"by\" - ay) * (cx - ax)) * sign((bx - ax) * (dy - ay) - (\"by\" - ay) * (dx - ax)) <= 0
                AND sign((dx - cx) * (ay - cy) - (dy - cy) * (ax - cx)) * sign((dx - cx) * (\"by\" - cy) - (dy - cy) * (bx - cx)) <= 0 END""",
    "cut_m": f"""SELECT seg, sum({METRES}) AS m FROM (SELECT seg, rn, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2
        FROM pcv2 WHERE cnt > 1 WINDOW w AS (PARTITION BY seg, rn ORDER BY n)) WHERE x2 IS NOT NULL GROUP BY seg""",
    "audit": """SELECT net.seg, reason, total AS before,
        CASE WHEN reason LIKE 'fewer%' THEN 0e0 ELSE coalesce(m, 0e0) END AS after
        FROM net JOIN tot USING (seg) LEFT JOIN cut_m USING (seg) LEFT JOIN fail USING (seg)""",
    "pshape": "SELECT seg * 100000 + piece_no AS seg, n AS idx, x, y FROM piece_v",
    "bucket": """SELECT seg, piece_no, CASE WHEN m <= 0.01 THEN 'A. <=1cm' WHEN m <= 0.1 THEN 'B. 1cm-10cm'
        WHEN m <= 1 THEN 'C. 10cm-1m' WHEN m <= 100 THEN 'D. 1m-100m' WHEN m <= 1000 THEN 'E. 100m-1km'
        WHEN m <= 10000 THEN 'F. 1km-10km' ELSE 'G. >10km' END AS bucket
        FROM (SELECT seg, piece_no, e_m - s_m AS m FROM piece)""",
    "metric": """SELECT seg, piece_no, 'length' AS key, bucket AS value FROM bucket UNION ALL
        SELECT seg, piece_no, 'original_self_intersecting', 'true' FROM piece JOIN crossed USING (seg) UNION ALL
        SELECT seg // 100000, seg % 100000, 'split_self_intersecting', 'true' FROM pcrossed""",
    "feat": "SELECT seg::VARCHAR AS id, 'segment' AS type FROM net UNION ALL SELECT cid, 'connector' FROM con",
}

PARTS["pdv"] = PARTS["dv"].replace("{shape}", "pshape")
PARTS["pde"] = PARTS["de"].replace("dv", "pdv")
PARTS["pcrossed"] = PARTS["crossed"].replace("FROM de a JOIN de b", "FROM pde a JOIN pde b")
# Cutting at the outermost connectors only.
OUTERMOST = {"placed": "outer_placed", "more_fail": "OR seg NOT IN (SELECT seg FROM placed)"}


def metres(x: str, y: str, x2: str, y2: str) -> str:
    names = {"x": x, "y": y, "x2": x2, "y2": y2}
    return re.sub(r"\b(x2|y2|x|y)\b", lambda m: names[m[0]], METRES)


def assemble(select: str, placed: str = "placed", more_fail: str = "", **parts: str) -> str:
    """Put the parts a statement needs in front of it, in order of definition."""
    known = {**PARTS, **parts}
    texts = {
        k: t.replace("{placed}", placed).replace("{shape}", "vv").replace("{more_fail}", more_fail)
        for k, t in known.items()
    }
    needed: set[str] = set()
    stack = [select]
    while stack:
        for word in _words(stack.pop()) & set(texts):
            if word not in needed:
                needed.add(word)
                stack.append(texts[word])
    ordered = [k for k in texts if k in needed]
    ordered.sort(key=lambda k: _depth(k, texts))
    ctes = ",\n".join(
        f"{k} AS ({texts[k]})" if k == "fold" else f"{k} AS MATERIALIZED ({texts[k]})" for k in ordered
    )
    return f"WITH RECURSIVE {ctes}\n{select}" if ctes else select


def _depth(name: str, texts: dict[str, str], seen: tuple[str, ...] = ()) -> int:
    users = _words(texts[name]) & set(texts) - {name, *seen}
    return 1 + max((_depth(u, texts, (*seen, name)) for u in users), default=0)


def _words(sql: str) -> set[str]:
    return set(re.findall(r"\b[a-z_]\w*\b", re.sub(r"'[^']*'", "", sql)))
