"""SQL with the same meaning as the registered queries, for comparison on another engine.

Written from the definitions, in a long `(id, j, value)` layout: one row per row and feature.
"""

from __future__ import annotations

from tabml.functions import fixed
from tabml.operators.learners.trees import DRAW_STEPS, subset_size
from tabml.plans.queries import (
    CUSTOMER_FEATURES, DBSCAN_EPS, DBSCAN_MIN_PTS, DIRTY, DIRTY_COLUMNS, EMBEDDING_EPS, EMBEDDING_MIN_PTS, KMEANS_MANY, KMEANS_ROUNDS, KMEANS_START, PROBLEM_TARGETS,
)

DIRTY_SQL = "select " + ", ".join(f"{e.format(STR='varchar')} as {c}" for c, e in DIRTY.items()) + " from orders"
EVENTS_SQL = "select event_id, event_type, value, user_id, cast(json_extract_string(props, '$.k') as double) as k from events"
TOKENS = ", ".join(f"'{t}'" for t in fixed.MISSING_TOKENS)
NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def r6(e: str) -> str:
    return f"floor(({e})*1e6+0.5)/1e6"


def miss(c: str) -> str:
    return f"({c} is null or lower(trim({c})) in ({TOKENS}))"


def num(c: str) -> str:
    bare = f"trim(translate({c}, '$,%', ''))"
    return f"(case when {miss(c)} then null when regexp_full_match({bare}, '{NUMBER}') then try_cast({bare} as double) end)"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- shared steps -------------------------------------------------------------------------------


def numeric_stats(parts: list[tuple[str, str, str, str, str]]) -> str:
    """CTEs for fitted numeric columns from (source name, source sql, column, number, missing test)."""
    raw = " union all ".join(f"select '{n}' as source, '{c}' as col, cast({v} as double) as v, {m} as m from ({s})" for n, s, c, v, m in parts)
    return f"""raw as ({raw}),
q as (select source, col, quantile_cont(v, 0.25) q1, quantile_cont(v, 0.5) med, quantile_cont(v, 0.75) q3,
      sum(case when m then 1 else 0 end) missing from raw group by 1, 2),
f as (select *, q1 - 1.5*(q3-q1) lo, q3 + 1.5*(q3-q1) hi from q),
fill as (select raw.source, raw.col, lo, hi, coalesce(v, med) v from raw join f using (source, col)),
st as (select source, col, avg(case when lo = hi then v else least(hi, greatest(lo, v)) end) mean,
       stddev_pop(case when lo = hi then v else least(hi, greatest(lo, v)) end) std,
       sum(case when v < lo or v > hi then 1 else 0 end) outliers from fill group by 1, 2)"""


NUMERIC_PARTS = [
    ("events", "select * from events", "value", "value", "false"),
    ("events", "select * from events", "user_id", "user_id", "false"),
    ("documents", "select * from documents", "n_chars", "n_chars", "false"),
    *[("dirty", DIRTY_SQL, c, num(c), miss(c)) for c in ("price_txt", "pct_txt")],
]


def prep(source: str, key: str, columns: list[str], digits: int | None = None) -> str:
    """CTEs ending in `z(id, j, x)`: imputed, capped and standardised numeric columns."""
    value = "(c - mean)/std" if digits is None else f"floor((c - mean)/std*1e{digits}+0.5)/1e{digits}"
    long = " union all ".join(f"select {key} as id, {j} as j, cast({c} as double) as v from src" for j, c in enumerate(columns))
    return f"""src as ({source}), lng as ({long}),
qs as (select j, quantile_cont(v, 0.25) q1, quantile_cont(v, 0.5) med, quantile_cont(v, 0.75) q3 from lng group by j),
fen as (select j, med, q1 - 1.5*(q3-q1) lo, q3 + 1.5*(q3-q1) hi from qs),
cl as (select id, j, case when lo = hi then coalesce(v, med) else least(hi, greatest(lo, coalesce(v, med))) end c from lng join fen using (j)),
ms as (select j, avg(c) mean, case when stddev_pop(c) = 0 then 1 else stddev_pop(c) end std from cl group by j),
z as (select id, j, {value} x from cl join ms using (j))"""


def split(key: str, source: str = "src") -> str:
    """`sp(id, is_test)`."""
    return f"""sp as (select {key} as id, row_number() over (order by md5(concat('17-', cast({key} as varchar))), {key})
      <= greatest(1, cast(floor((select count(*) from {source}) * 0.25) as bigint)) as is_test from {source})"""


def categories(source: str, column: str, value: str) -> str:
    """`(col, mode, cats[], ...)` rows: rank, category."""
    return f"""select '{column}' as col, v as cat, row_number() over (order by count(*) desc, v) as rnk
      from (select coalesce({value}, '__missing__') as v from ({source})) group by v"""


def with_other(rows: str) -> str:
    return f"select col, cat, rnk from ({rows}) where rnk <= 12 union all select col, '__other__', 99 from ({rows}) where rnk <= 12 group by col"


NB = f"""{prep(EVENTS_SQL, 'event_id', ['value', 'user_id', 'k'])}, {split('event_id')},
cls as (select event_type, dense_rank() over (order by event_type) - 1 as c from (select distinct event_type from src)),
lab as (select event_id as id, c from src join cls using (event_type)),
pri as (select c, count(*) * 1.0 / sum(count(*)) over () as prior from lab join sp using (id) where not is_test group by c),
par as (select c, j, avg(x) m, greatest(var_pop(x), 1e-4) v from z join lab using (id) join sp using (id) where not is_test group by c, j),
sc as (select id, par.c, ln(max(prior)) + sum(-0.5*ln(2*pi()*v) - (x-m)*(x-m)/(2*v)) s
       from z join par using (j) join pri on pri.c = par.c group by id, par.c),
pr as (select id, c, exp(s - max(s) over (partition by id)) e from sc),
pb as (select id, c, e / sum(e) over (partition by id) p from pr),
best as (select id, c as pred, p from (select *, row_number() over (partition by id order by p desc, c) rn from pb) where rn = 1),
test as (select best.id, lab.c as label, pred, p from best join lab using (id) join sp using (id) where is_test)"""

PART_SQL = "select p_partkey, p_partkey as number, p_size, p_retailprice from part"
LINEAR = f"""{prep(PART_SQL, 'p_partkey', ['number', 'p_size'])}, {split('p_partkey')},
pt as (select p_partkey as id, max(case when j = 0 then x end) x0, max(case when j = 1 then x end) x1, max(p_retailprice) y, bool_or(is_test) is_test
       from src join z on z.id = p_partkey join sp on sp.id = p_partkey group by p_partkey),
tr as (select * from pt where not is_test),
ym as (select avg(y) ymean, case when stddev_pop(y) = 0 then 1 else stddev_pop(y) end ystd from tr),
g as (select count(*) n, sum(x0) s0, sum(x1) s1, sum(x0*x0) s00, sum(x0*x1) s01, sum(x1*x1) s11,
      sum((y-ymean)/ystd) sy, sum(x0*(y-ymean)/ystd) s0y, sum(x1*(y-ymean)/ystd) s1y from tr, ym),
gd(step, b, w0, w1) as (select 0, 0.0::double, 0.0::double, 0.0::double union all
  select step + 1, b - 0.04*((n*b + s0*w0 + s1*w1 - sy)/n), w0 - 0.04*((s0*b + s00*w0 + s01*w1 - s0y)/n + 0.001*w0),
  w1 - 0.04*((s1*b + s01*w0 + s11*w1 - s1y)/n + 0.001*w1) from gd, g where step < 900),
w as (select * from gd where step = 900),
pred as (select id, y as actual, x0, x1, (b + x0*w0 + x1*w1)*ystd + ymean as predicted, w0*x0*ystd c0, w1*x1*ystd c1 from pt, w, ym where is_test)"""

CUSTOMER_SQL = "select c_custkey, c_acctbal, c_nationkey from customer"
POINTS = f"""{prep(CUSTOMER_SQL, 'c_custkey', ['c_acctbal', 'c_nationkey'])},
pts as (select id, max(case when j = 0 then x end) x0, max(case when j = 1 then x end) x1 from z group by id)"""


def lloyd(centers: list[tuple[float, float]] = KMEANS_START) -> str:
    start = " union all ".join(f"select {i} as c, {a} as m0, {b} as m1" for i, (a, b) in enumerate(centers))
    ctes = [f"k0 as ({start})"]
    for r in range(KMEANS_ROUNDS + 1):
        ctes.append(
            f"""a{r} as (select id, x0, x1, c, d from (select *, row_number() over (partition by id order by d, c) rn
            from (select id, x0, x1, c, (x0-m0)*(x0-m0) + (x1-m1)*(x1-m1) d from pts, k{r})) where rn = 1)"""
        )
        if r < KMEANS_ROUNDS:
            ctes.append(
                f"k{r + 1} as (select k{r}.c, coalesce(avg(x0), max(m0)) m0, coalesce(avg(x1), max(m1)) m1 from k{r} left join a{r} on a{r}.c = k{r}.c group by k{r}.c)"
            )
    return ", ".join(ctes)


KMEANS = f"{POINTS}, {lloyd()}"


def lloyd_until_settled() -> str:
    """CTE `own(id, c)`: three hash-drawn rows, then up to 80 rounds with one column per coordinate."""
    drawn = f"select x0, x1, row_number() over (order by md5(concat('{fixed.KMEANS['seed']}-', cast(id as varchar))), id) - 1 as r from pts"
    start = ", ".join(f"max(case when r = {c} then x{j} end) as c{c}_{j}" for c in range(3) for j in range(2))
    names = ", ".join(f"c{c}_{j}" for c in range(3) for j in range(2))
    away = ", ".join(f"(x0-c{c}_0)*(x0-c{c}_0) + (x1-c{c}_1)*(x1-c{c}_1) as d{c}" for c in range(3))
    nearest = "case when d0 <= d1 and d0 <= d2 then 0 when d1 <= d2 then 1 else 2 end"
    moved = ", ".join(f"coalesce(avg(case when c = {c} then x{j} end), any_value(c{c}_{j})) as c{c}_{j}" for c in range(3) for j in range(2))
    return f"""dn as ({drawn}), km(step, {names}) as (select 0, {start} from dn where r < 3 union all
  select step + 1, {moved} from (select *, {nearest} as c from (select *, {away} from km, pts where step < {fixed.KMEANS['rounds']})) group by step),
own as (select id, {nearest} as c from (select *, {away} from km, pts where step = {fixed.KMEANS['rounds']}))"""

EPS = """smp as (select id, x0, x1 from pts),
fifth as (select a, d from (select a.id a, sqrt((a.x0-b.x0)*(a.x0-b.x0)+(a.x1-b.x1)*(a.x1-b.x1)) d,
  row_number() over (partition by a.id order by sqrt((a.x0-b.x0)*(a.x0-b.x0)+(a.x1-b.x1)*(a.x1-b.x1))) rn from smp a join smp b on a.id <> b.id) where rn = 5),
eps as (select case when d = 0 then 1 else d end eps from (select case when d = 0 then 1 else d end d, row_number() over (order by case when d = 0 then 1 else d end) rn from fifth)
  where rn = cast(floor((select count(*) from fifth)*0.65) as bigint) + 1),
mp as (select least(5, greatest(3, cast(floor(sqrt((select count(*) from pts))/2 + 0.5) as bigint))) min_pts)"""
GIVEN = f"eps as (select {DBSCAN_EPS}::double eps), mp as (select {DBSCAN_MIN_PTS} min_pts)"


FLAT_DISTANCE = "sqrt((a.x0-b.x0)*(a.x0-b.x0)+(a.x1-b.x1)*(a.x1-b.x1))"


def dbscan(parameters: str, points: str = POINTS, distance: str = FLAT_DISTANCE) -> str:
    return f"""{points}, {parameters},
nb as materialized (select a.id a, b.id b from pts a join pts b on {distance} <= (select eps from eps)),
core as (select a as id from nb group by a having count(*) >= (select min_pts from mp)),
cc as (select a, b from nb where a in (select id from core) and b in (select id from core)),
reach(id, l) using key (id) as (select id, id from core union
  select cc.b, min(reach.l) from reach join cc on cc.a = reach.id join recurring.reach cur on cur.id = cc.b where reach.l < cur.l group by cc.b),
comp as (select id, dense_rank() over (order by l) - 1 as c from reach),
bord as (select a as id, min(c) as c from nb join comp on comp.id = nb.b where a not in (select id from core) group by a),
lab as (select pts.id, case when core.id is null then 0 else 1 end is_core, cast(coalesce(comp.c, bord.c, -1) as integer) c
  from pts left join core using (id) left join comp using (id) left join bord using (id))"""


DB = dbscan(GIVEN)
SUPPLIER_POINTS = """sup as (select s_suppkey as id, (case when f0.lo = f0.hi then s_acctbal else least(f0.hi, greatest(f0.lo, s_acctbal)) end - m0.mean)/m0.std x0,
  (case when f1.lo = f1.hi then s_nationkey else least(f1.hi, greatest(f1.lo, s_nationkey)) end - m1.mean)/m1.std x1
  from supplier, fen f0, fen f1, ms m0, ms m1 where f0.j = 0 and f1.j = 1 and m0.j = 0 and m1.j = 1)"""

PCA = f"""{prep('select p_partkey, p_size, p_retailprice from part', 'p_partkey', ['p_size', 'p_retailprice'])},
pts as (select id, max(case when j = 0 then x end) x0, max(case when j = 1 then x end) x1 from z group by id),
mu as (select avg(x0) u0, avg(x1) u1 from pts),
cv as (select avg((x0-u0)*(x0-u0)) a, avg((x0-u0)*(x1-u1)) b, avg((x1-u1)*(x1-u1)) d from pts, mu),
p1(s, v0, v1) as (select 0, 1.0::double, 0.3::double union all
  select s+1, (a*v0+b*v1)/sqrt((a*v0+b*v1)**2+(b*v0+d*v1)**2), (b*v0+d*v1)/sqrt((a*v0+b*v1)**2+(b*v0+d*v1)**2) from p1, cv where s < 80),
f as (select v0, v1, v0*(a*v0+b*v1)+v1*(b*v0+d*v1) lam from p1, cv where s = 80),
df as (select a-lam*v0*v0 a, b-lam*v0*v1 b, d-lam*v1*v1 d from cv, f),
p2(s, v0, v1) as (select 0, 1.0::double, 0.3::double union all
  select s+1, (a*v0+b*v1)/sqrt((a*v0+b*v1)**2+(b*v0+d*v1)**2), (b*v0+d*v1)/sqrt((a*v0+b*v1)**2+(b*v0+d*v1)**2) from p2, df where s < 80),
g as (select v0, v1 from p2 where s = 80)"""

CONFUSION = """ct as materialized (select label, pred, count(*) n from test group by 1, 2),
cm as (select a.c as actual, b.c as predicted, coalesce(ct.n, 0) n from cls a cross join cls b left join ct on ct.label = a.c and ct.pred = b.c)"""
CLASS_METRICS = CONFUSION + """, tp as (select actual c, sum(case when actual = predicted then n else 0 end) tp, sum(case when actual <> predicted then n else 0 end) fn from cm group by 1),
fp as (select predicted c, sum(case when actual <> predicted then n else 0 end) fp from cm group by 1),
pc as (select c, case when tp+fp = 0 then 0 else tp*1.0/(tp+fp) end pre, case when tp+fn = 0 then 0 else tp*1.0/(tp+fn) end rec from tp join fp using (c)),
f1 as (select c, pre, rec, case when pre+rec = 0 then 0 else 2.0*pre*rec/(pre+rec) end f1 from pc)"""


def diagnosis(name: str, source: str, target: str, typed: bool | None) -> str:
    value = f"cast({target} as double)" if typed else num(f"cast({target} as varchar)")
    absent = f"({target} is null)" if typed else miss(f"cast({target} as varchar)")
    head, tail = fixed.WHY_FEW_VALUES.format(target=target, n="{n}").split("{n}")
    return f"""select '{name}' as source, case when isnum and not few then 'regression' else 'classification' end problem_type,
  case when not isnum then {text(fixed.WHY_LABELS.format(target=target))}
       when few then concat({text(head)}, cast(nd as varchar), {text(tail)})
       else {text(fixed.WHY_MANY_VALUES.format(target=target))} end rationale
  from (select *, whole and nd <= greatest(2, least(20, floor(parsed * 0.12))) few from (
    select {'true' if typed else "count(v) >= 0.85 * sum(case when m then 0 else 1 end) and count(v) > 0"} isnum, count(distinct v) nd, count(v) parsed,
    coalesce(bool_and(abs(v - round(v)) < 1e-9), true) whole from (select {value} v, {absent} m from ({source}))))"""


def preprocessing_rows(source: str, missing: str, outliers: str, ncat: int, nnum: int, classes: str | None) -> str:
    rows = []
    for step, (title, n) in enumerate(zip(fixed.SUMMARY, (missing, outliers, str(ncat), str(nnum))), start=1):
        none, some = fixed.SUMMARY[title]
        head, tail = some.split("{n}")
        rows.append(
            f"select '{source}' as source, {step} as step, '{title}' as title, case when ({n}) = 0 then {text(none)} else concat({text(head)}, cast(({n}) as varchar), {text(tail)}) end as body"
        )
    if classes:
        head, tail = fixed.SUMMARY_TARGET[1].split("{classes}")
        rows.append(f"select '{source}', 5, '{fixed.SUMMARY_TARGET[0]}', concat({text(head)}, ({classes}), {text(tail)})")
    return " union all ".join(rows)


def outliers_of(parts: list[tuple[str, str]]) -> str:
    """Number of values outside the fences over (source sql, number expression)."""
    return " + ".join(
        f"""(select sum(case when v < q1 - 1.5*(q3-q1) or v > q3 + 1.5*(q3-q1) then 1 else 0 end) from
        (select coalesce(v, med) v, q1, q3 from (select cast({e} as double) v from ({s})), (select quantile_cont(cast({e} as double), 0.25) q1, quantile_cont(cast({e} as double), 0.5) med, quantile_cont(cast({e} as double), 0.75) q3 from ({s}))))"""
        for s, e in parts
    )


def histogram(source: str, value: str, extra: str = "") -> str:
    return f"""with v as (select cast({value} as double) v from {source} where {value} is not null),
s as (select min(v) lo, max(v) hi, least(8, greatest(4, cast(ceil(sqrt(count(*))) as bigint))) bins from v),
c as (select least(bins-1, cast(floor((v-lo)/(hi-lo)*bins) as bigint)) bin, count(*) n from v, s group by 1)
select r.bin, {r6('lo+(hi-lo)/bins*r.bin')} bin_start, {r6('lo+(hi-lo)/bins*(r.bin+1)')} bin_end, coalesce(n, 0) n {extra}
from s, (select unnest(range(0, (select bins from s))) bin) r left join c on c.bin = r.bin"""


def softmax_steps(classes: int, width: int) -> str:
    """CTE `gd`: gradient steps over `tr(id, y, x0, ...)`, one column per weight, position 0 is the bias."""
    cells = [(c, j) for c in range(classes) for j in range(width + 1)]
    names = ", ".join(f"w{c}_{j}" for c, j in cells)
    scores = ", ".join(f"w{c}_0 + " + " + ".join(f"w{c}_{j + 1}*x{j}" for j in range(width)) + f" as s{c}" for c in range(classes))
    top = "greatest(" + ", ".join(f"s{c}" for c in range(classes)) + ")"
    exps = ", ".join(f"exp(s{c} - {top}) as e{c}" for c in range(classes))
    total = "(" + "+".join(f"e{c}" for c in range(classes)) + ")"
    errors = ", ".join(f"e{c}/{total} - case when y = {c} then 1.0 else 0.0 end as d{c}" for c in range(classes))
    sums = ", ".join(f"sum(d{c}{'' if j == 0 else f'*x{j - 1}'}) as g{c}_{j}" for c, j in cells)
    moved = ", ".join(f"w{c}_{j} - 0.08*(g{c}_{j}/n{'' if j == 0 else f' + 0.001*w{c}_{j}'})" for c, j in cells)
    kept = ", ".join(f"any_value(w{c}_{j}) as w{c}_{j}" for c, j in cells)
    return f"""gd(step, {names}) as (select 0, {', '.join('0.0::double' for _ in cells)} union all select step + 1, {moved} from (
      select step, count(*) as n, {kept}, {sums} from (select *, {errors} from (select *, {exps} from (select *, {scores} from gd, tr where step < {fixed.SOFTMAX['epochs']}))) group by step))"""


def tree(train: str, classes: int | None, limits: dict = fixed.TREE, trees: int = 1, subset: int | None = None) -> str:
    """CTEs ending in `leaf(tree, node, ...)` and `at{depth}(id, tree, node)`.

    `train(id, y)` lists the training rows; `z(id, j, x)` holds the features of all rows. With a
    `subset` rows are drawn and features chosen by hashes.
    """
    names = [f"s{c}" for c in range(classes)] if classes else ["s0", "s1", "s2"]
    own = [f"case when y = {c} then 1.0 else 0.0 end" for c in range(classes)] if classes else ["1.0", "y - ym", "(y - ym)*(y - ym)"]
    seed, low, gain = fixed.FOREST["seed"], limits["min_rows"], limits["min_gain"]
    number = f"cast(concat('0x', substr(md5(concat('{seed}-', cast(tree as varchar), '-', cast(id as varchar))), 1, 8)) as bigint)"
    draws = " + ".join(f"(case when {number} >= {s} then 1 else 0 end)" for s in DRAW_STEPS) if subset else "1"
    hashed = f"md5(concat('{seed}-', cast(tree as varchar), '-', cast(node as varchar), '-', cast(j as varchar)))"
    chosen = f"where ch <= {subset}" if subset else ""

    def size(p):
        return "(" + "+".join(f"{p}{n}" for n in names) + ")" if classes else f"{p}s0"

    def impurity(p):
        if classes:
            return "(1 - (" + "+".join(f"({p}{n}/{size(p)})*({p}{n}/{size(p)})" for n in names) + "))"
        return f"greatest(0.0, {p}s2/{p}s0 - ({p}s1/{p}s0)*({p}s1/{p}s0))"

    ctes = [
        f"{train}, tm as (select avg(y) ym from train), forest as (select unnest(range(0, {trees})) as tree)",
        f"dr as materialized (select id, tree, y, {draws} as w from train, forest)",
        f"lb as materialized (select id, tree, {', '.join(f'w*({e}) as {n}' for e, n in zip(own, names))} from dr, tm where w > 0)",
        "ft as (select distinct j from z)",
        "at0 as materialized (select id, tree, 1 as node from (select distinct id from z), forest)",
    ]
    for d in range(limits["depth"]):
        sums = ", ".join(f"sum({n}) as {n}" for n in names)
        running = ", ".join(f"sum({n}) over w as l_{n}, sum({n}) over p as t_{n}" for n in names)
        right = ", ".join(f"t_{n} - l_{n} as r_{n}" for n in names)
        ctes += [
            f"al{d} as (select tree, node, j from (select *, row_number() over (partition by tree, node order by {hashed}) as ch from (select distinct tree, node from at{d} where node >= {2**d}), ft) {chosen})",
            f"v{d} as (select tree, node, j, x, {sums} from at{d} join lb using (id, tree) join al{d} using (tree, node) join z using (id, j) group by tree, node, j, x)",
            f"k{d} as (select *, {right} from (select tree, node, j, x, row_number() over w as r, lead(x) over w as nx, count(*) over p as dv, {running} from v{d} "
            f"window w as (partition by tree, node, j order by x rows unbounded preceding), p as (partition by tree, node, j)))",
            f"g{d} as (select tree, node, j, r, (x + nx)/2 as thr, {impurity('t_')} - (({size('l_')}/{size('t_')})*{impurity('l_')} + ({size('r_')}/{size('t_')})*{impurity('r_')}) as gain "
            f"from k{d} where r < dv and r % greatest(1, dv // {fixed.TREE_CANDIDATES}) = 0 and {size('l_')} >= {low} and {size('r_')} >= {low} and {size('t_')} > {low} and {impurity('t_')} > {gain})",
            f"b{d} as (select * from (select *, row_number() over (partition by tree, node order by gain desc, j, r) as rn from g{d}) where rn = 1 and gain > {gain})",
            f"at{d + 1} as materialized (select a.id, a.tree, case when b.node is null then a.node when z.x <= b.thr then 2*a.node else 2*a.node + 1 end as node "
            f"from at{d} a left join b{d} b on b.node = a.node and b.tree = a.tree left join z on z.id = a.id and z.j = b.j)",
        ]
    ctes.append(f"leaf as (select tree, node, {', '.join(f'sum({n}) as {n}' for n in names)} from at{limits['depth']} join lb using (id, tree) group by tree, node)")
    return ", ".join(ctes)


def class_trees(**shape) -> str:
    """CTEs ending in `lp(tree, node, c, p)`: the class of each leaf."""
    counts = " union all ".join(f"select tree, node, {c} as c, s{c} as n from leaf" for c in range(5))
    return f"""{prep(EVENTS_SQL, 'event_id', ['value', 'user_id', 'k'], 9)}, {split('event_id')},
cls as (select event_type, dense_rank() over (order by event_type) - 1 as c from (select distinct event_type from src)),
lab as (select event_id as id, c as y from src join cls using (event_type)),
{tree('train as (select id, y from lab join sp using (id) where not is_test)', 5, **shape)}, lc as ({counts}),
lp as (select * from (select tree, node, c, n/sum(n) over (partition by tree, node) p, row_number() over (partition by tree, node order by n desc, c) rn from lc) where rn = 1)"""


def value_trees(**shape) -> str:
    return f"""{prep(PART_SQL, 'p_partkey', ['number', 'p_size'], 9)}, {split('p_partkey')}, lab as (select p_partkey as id, p_retailprice as y from src),
{tree('train as (select id, y from lab join sp using (id) where not is_test)', None, **shape)}"""


CLASS_FOREST = {"limits": fixed.FOREST, "trees": fixed.FOREST["classification_trees"], "subset": subset_size(3)}
VALUE_FOREST = {"limits": fixed.FOREST, "trees": fixed.FOREST["regression_trees"], "subset": subset_size(2)}
SOFTMAX = f"""{prep(EVENTS_SQL, 'event_id', ['value', 'user_id', 'k'])}, {split('event_id')},
cls as (select event_type, dense_rank() over (order by event_type) - 1 as c from (select distinct event_type from src)),
pt as materialized (select event_id as id, any_value(c) as y, max(case when j = 0 then x end) x0, max(case when j = 1 then x end) x1, max(case when j = 2 then x end) x2, bool_or(is_test) is_test
  from src join cls using (event_type) join z on z.id = event_id join sp on sp.id = event_id group by event_id),
tr as materialized (select * from pt where not is_test), {softmax_steps(5, 3)},
w as materialized (select * from gd where step = {fixed.SOFTMAX['epochs']}),
sm as ({' union all '.join(f'select pt.id, y, {c} as c, w{c}_0 + w{c}_1*x0 + w{c}_2*x1 + w{c}_3*x2 as s from pt, w where is_test' for c in range(5))}),
pm as (select id, y, c, exp(s - max(s) over (partition by id)) e from sm),
pq as (select id, y, c, e / sum(e) over (partition by id) p, row_number() over (partition by id order by e desc, c) rn from pm)"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["expr_missing"] = f"select row_id, {', '.join(f'case when {miss(c)} then 1 else 0 end as {c}' for c in DIRTY_COLUMNS)} from ({DIRTY_SQL})"
    sql["expr_to_number"] = f"select row_id, {', '.join(f'{num(c)} as {c}' for c in DIRTY_COLUMNS)} from ({DIRTY_SQL})"
    usable = [("price_txt/regression", f"{num('price_txt')} is not null"), ("status_txt/classification", f"not {miss('status_txt')}"),
              ("mixed_txt/regression", f"{num('mixed_txt')} is not null"), ("None/unsupervised", "true")]
    sql["filter_usable_rows"] = " union all ".join(f"select row_id, '{n}' as source from ({DIRTY_SQL}) where {t}" for n, t in usable)
    sql["src_csv_shape"] = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders"
    sql["src_csv_messy"] = """select doc_id, trim(text, concat(' ', chr(9), chr(10), chr(13))) as text, concat('said "', lang, '"; ', source) as note, lang as note_2 from documents"""
    sql["row_id_by_key"] = "select c_custkey, c_name, row_number() over (order by c_name) - 1 as row_id from customer"
    sql["preview_rows"] = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders order by o_orderkey limit 8"
    sql["sample_systematic"] = " union all ".join(
        f"""select o_orderkey, '{cap}' as source from (select o_orderkey, row_number() over (order by o_orderkey) - 1 p, count(*) over () n from orders)
        where n <= {cap} or p in (select cast(floor(i * ((select count(*) from orders) / {cap}::double)) as bigint) from range(0, {cap}) t(i))"""
        for cap in (fixed.ROW_CAP, fixed.DBSCAN_ROW_CAP)
    )
    sql["split_holdout"] = f"with {split('o_orderkey', 'orders')} select id as o_orderkey, cast(is_test as integer) as is_test from sp"

    columns = " union all ".join(
        f"""select '{c}' as "column", {i} as position, case when ratio >= 0.85 then 'numeric' else 'categorical' end kind, missing, uniq as "unique", {r6('ratio')} numeric_ratio
        from (select *, case when present = 0 then 0 else parsed*1.0/present end ratio from (select count(*) filter ({miss(c)}) missing, count(distinct case when not {miss(c)} then trim({c}) end) uniq,
        count(*) filter (not {miss(c)}) present, count({num(c)}) parsed from ({DIRTY_SQL})))"""
        for i, c in enumerate(DIRTY_COLUMNS)
    )
    sql["profile_columns"] = columns
    sql["profile_dataset"] = f"""select (select count(*) from orders) "rows", count(*) "columns", count(*) filter (kind = 'numeric') numeric_columns,
        count(*) filter (kind <> 'numeric') categorical_columns, cast(sum(missing) as bigint) missing from ({columns})"""
    sql["missing_top8"] = f'select "column", position, missing from ({columns}) order by missing desc, position limit 8'
    parts = [
        diagnosis(f"{n}.{t}", DIRTY_SQL if n == "dirty" else f"select {t} from {n}", t, n not in ("dirty", "orders")) for n, t in PROBLEM_TARGETS
    ]
    sql["problem_type"] = " union all ".join(parts) + f" union all select 'orders', 'unsupervised', {text(fixed.WHY_UNSUPERVISED)}"
    sql["target_class_counts"] = f"select trim(status_txt) as label, count(*) as n from ({DIRTY_SQL}) where not {miss('status_txt')} group by 1"
    sql["target_values"] = f"select {num('price_txt')} as value from ({DIRTY_SQL}) where {num('price_txt')} is not null"
    sql["count_values_first_seen"] = "select o_orderpriority as label, count(*) as n, min(o_orderkey) as first_row from orders group by 1"
    sql["histogram_value"] = histogram("events", "value")
    sql["histogram_first_numeric"] = histogram("documents", "n_chars", ", 'n_chars' as \"column\"")
    sql["quartiles"] = " union all ".join(
        f"select '{t}' as source, '{c}' as \"column\", {', '.join(r6(f'quantile_cont(cast({c} as double), {q})') + ' as ' + n for q, n in ((.25, 'q1'), (.5, 'median'), (.75, 'q3')))} from {t}"
        for t, c in (("events", "value"), ("events", "user_id"), ("documents", "n_chars"), ("lineitem", "l_extendedprice"), ("lineitem", "l_discount"))
    )
    sql["mean_std"] = " union all ".join(
        f"select '{n}' as source, '{c}' as \"column\", {r6(f'coalesce(avg({e}), 0)')} as mean, {r6(f'coalesce(stddev_pop({e}), 0)')} as std from ({s})"
        for n, s, c, e in [("events", "select * from events", "value", "value"), ("events", "select * from events", "user_id", "user_id")]
        + [("dirty", DIRTY_SQL, c, num(c)) for c in ("price_txt", "pct_txt", "empty_txt")]
    )
    sql["minmax_scale"] = f"select doc_id, {r6('(n_chars - lo)*1.0/(hi - lo)')} as scaled from documents, (select min(n_chars) lo, max(n_chars) hi from documents)"

    stats = numeric_stats(NUMERIC_PARTS)
    sql["fit_numeric"] = f"""with {stats} select source, col as "column", {r6('med')} median, {r6('q1')} q1, {r6('q3')} q3, {r6('lo')} lower, {r6('hi')} upper,
        {r6('mean')} mean, {r6('case when std = 0 then 1 else std end')} std, cast(missing as bigint) missing from f join st using (source, col)"""
    sql["outlier_counts"] = f"with {stats} select source, cast(sum(outliers) as bigint) outliers, cast(sum(missing) as bigint) missing from f join st using (source, col) group by source"
    z = "select id, max(case when j = 0 then x end) z0, max(case when j = 1 then x end) z1 from z group by id"
    sql["transform_numeric"] = " union all ".join(
        f"select '{n}' as source, id, {r6('z0')} z0, {r6('z1')} z1 from (with {prep(s, k, c)} {z})"
        for n, s, k, c in (("dirty", DIRTY_SQL, "row_id", [num("price_txt"), num("pct_txt")]), ("events", "select * from events", "event_id", ["value", "user_id"]))
    )
    cats = []
    for source, s, columns_ in (("part", "part", ("p_brand", "p_type", "p_name")), ("customer", "customer", ("c_mktsegment", "c_name")), ("dirty", f"({DIRTY_SQL})", ("status_txt", "empty_txt"))):
        for c in columns_:
            rows = categories(f"select * from {s}", c, f"case when not {miss(c)} then trim({c}) end")
            cats.append(
                f"""select '{source}' as source, '{c}' as "column", min_by(cat, rnk) as mode, string_agg(cat, '|' order by rnk) as categories,
                (select count(*) from {s} where {miss(c)}) as missing from ({with_other(rows)})"""
            )
    sql["fit_categorical"] = " union all ".join(cats)
    onehot = []
    for source, s, key, c in (("part", "select * from part", "p_partkey", "p_brand"), ("dirty", DIRTY_SQL, "row_id", "status_txt")):
        rows = with_other(categories(s, c, f"case when not {miss(c)} then trim({c}) end"))
        onehot.append(
            f"""select '{source}' as source, id, string_agg(case when cat = own then '1' else '0' end, '' order by rnk) as onehot from
            (select id, case when raw in (select cat from ({rows})) then raw else '__other__' end own from
            (select {key} as id, case when {miss(c)} then (select min_by(cat, rnk) from ({rows})) else trim({c}) end raw from ({s}))), ({rows}) group by id"""
        )
    sql["transform_onehot"] = " union all ".join(onehot)
    sql["encode_target"] = f"select row_id, cast(dense_rank() over (order by trim(status_txt)) - 1 as double) as label from ({DIRTY_SQL}) where not {miss('status_txt')}"
    numeric_first = [f"select {i} as pos, '{c}' as name" for i, c in enumerate(CUSTOMER_FEATURES[:2])]
    segment = with_other(categories("select * from customer", "c_mktsegment", "c_mktsegment"))
    named = " union all ".join([*numeric_first, f"select 1 + row_number() over (order by rnk), concat('c_mktsegment = ', cat) from ({segment})"])
    sql["feature_names"] = f"select cast(pos as bigint) as position, name from ({named})"
    sql["feature_kind_counts"] = f"select 'Numeric' as kind, 2 as n union all select 'Categorical', 1 union all select 'Encoded', count(*) from ({named})"
    sql["preprocessing_summary"] = " union all ".join(
        [
            preprocessing_rows("events", "0", outliers_of([(EVENTS_SQL, c) for c in ("value", "user_id", "k")]), 0, 3, "select string_agg(event_type, ', ' order by event_type) from (select distinct event_type from events)"),
            preprocessing_rows(
                "dirty",
                f"select sum(case when {miss('pct_txt')} then 1 else 0 end) + sum(case when {miss('status_txt')} then 1 else 0 end) + sum(case when {miss('empty_txt')} then 1 else 0 end) from ({DIRTY_SQL}) where {num('price_txt')} is not null",
                outliers_of([(f"select * from ({DIRTY_SQL}) where {num('price_txt')} is not null", num("pct_txt"))]), 2, 1, None,
            ),
            preprocessing_rows("part", "0", "0", 1, 0, None),
        ]
    )
    sql["health_summary"] = f"""select count(*) as "rows", 4::bigint as "columns", 3::bigint as numeric_columns, 1::bigint as categorical_columns, 3::bigint as features, 3::bigint as encoded_features,
        'Classification' as task, {text(fixed.WHY_LABELS.format(target='event_type'))} as rationale from events"""
    spread = f"""with {prep('select * from customer', 'c_custkey', CUSTOMER_FEATURES[:2])}, cat as ({segment})
        select cast(j as bigint) as position, case when j = 0 then '{CUSTOMER_FEATURES[0]}' else '{CUSTOMER_FEATURES[1]}' end as name, stddev_pop(x) as s from z group by j
        union all select 1 + row_number() over (order by rnk), concat('c_mktsegment = ', cat), s from
        (select cat, rnk, stddev_pop(case when c_mktsegment = cat then 1.0 else 0.0 end) s from customer, cat group by 1, 2)"""
    sql["feature_dispersion"] = f"select position, name, {r6('s')} as dispersion from ({spread})"

    sql["nb_fit"] = f"with {NB} select par.c as class_index, cast(j as bigint) as position, {r6('prior')} as prior, {r6('m')} as mean, {r6('v')} as variance from par join pri using (c)"
    sql["nb_predict"] = f"with {NB} select id as event_id, cast(label as double) as label, cast(pred as double) as prediction, {r6('p')} as top_probability from test"
    sql["linreg_fit"] = f"with recursive {LINEAR} select 0::bigint as position, {r6('b')} as weight from w union all select 1, {r6('w0')} from w union all select 2, {r6('w1')} from w"
    sql["linreg_predict"] = f"with recursive {LINEAR} select id as p_partkey, {r6('actual')} as actual, {r6('predicted')} as predicted from pred"
    knn_embed = "em as (select vec_id as id, cast(embedding as double[]) as e, label from embeddings)"
    sql["knn_neighbors"] = f"""with {knn_embed}, d as (select a.id, b.id as nid, list_distance(a.e, b.e) d from em a join em b on a.id <> b.id),
        r as (select *, row_number() over (partition by id order by d, nid) rn from d) select id as vec_id, cast(rn as integer) as rank, nid as neighbor_id, {r6('d')} as distance from r where rn <= 5"""
    vote = "least(7, greatest(3, cast(floor(sqrt((select count(*) from sp where not is_test)) + 0.5) as bigint)))"
    sql["knn_classify"] = f"""with {knn_embed}, {split('vec_id', 'embeddings')},
        d as (select a.id, b.id nid, b.label, list_distance(a.e, b.e) d from em a join em b on true where a.id in (select id from sp where is_test) and b.id in (select id from sp where not is_test)),
        r as (select *, row_number() over (partition by id order by d, nid) rn from d),
        v as (select id, label, sum(1/(d + 1e-6)) s from r where rn <= {vote} group by 1, 2),
        p as (select id, label, s / sum(s) over (partition by id) p, row_number() over (partition by id order by s desc, label) rn from v)
        select p.id as vec_id, cast(em.label as double) as label, cast(p.label as double) as prediction, {r6('p')} as top_probability from p join em using (id) where rn = 1"""
    sql["knn_regress"] = f"""with {prep(PART_SQL, 'p_partkey', ['number', 'p_size'], 9)}, {split('p_partkey')},
        pt as (select z.id, max(case when j = 0 then x end) x0, max(case when j = 1 then x end) x1, max(p_retailprice) y, bool_or(is_test) t from z join sp using (id) join src on p_partkey = z.id group by z.id),
        d as (select a.id, a.y, b.id nid, b.y ny, sqrt((a.x0-b.x0)*(a.x0-b.x0)+(a.x1-b.x1)*(a.x1-b.x1)) d from pt a join pt b on true where a.t and not b.t),
        r as (select *, row_number() over (partition by id order by d, nid) rn from d)
        select id as p_partkey, {r6('max(y)')} as actual, {r6('sum(ny/(d+1e-6))/sum(1/(d+1e-6))')} as predicted from r where rn <= {vote} group by id"""

    last = KMEANS_ROUNDS
    sql["kmeans_lloyd"] = f"with {KMEANS} select c::bigint as cluster, 0::bigint as position, {r6('m0')} as center from k{last} union all select c, 1, {r6('m1')} from k{last}"
    sql["kmeans_assign"] = f"with {KMEANS} select id as c_custkey, c as prediction from a{last}"
    sql["kmeans_inertia"] = f"with {KMEANS} select {r6('sum(d)')} as inertia from a{last}"
    sql["kmeans_drawn_rows"] = f"with recursive {POINTS}, {lloyd_until_settled()} select id as c_custkey, c as prediction from own"
    sql["dbscan_eps"] = f"with {POINTS}, {EPS} select {r6('eps')} as eps, cast(min_pts as integer) as min_pts from eps, mp"
    sql["dbscan_core"] = f"with recursive {DB} select id as c_custkey, is_core from lab"
    sql["dbscan_labels"] = f"with recursive {DB} select id as c_custkey, c as prediction from lab"
    sql["dbscan_auto"] = f"with recursive {dbscan(EPS)} select id as c_custkey, is_core, c as prediction from lab"
    wide = dbscan(f"eps as (select {EMBEDDING_EPS}::double eps), mp as (select {EMBEDDING_MIN_PTS} min_pts)", f"pts as (select vec_id as id, e from (select vec_id, cast(embedding as double[]) as e from embeddings))", "list_distance(a.e, b.e)")
    sql["dbscan_embeddings"] = f"with recursive {wide} select id as vec_id, is_core, c as prediction from lab"
    sql["dbscan_predict"] = f"""with recursive {DB}, {SUPPLIER_POINTS},
        d as (select sup.id, lab.c, sqrt((sup.x0-pts.x0)*(sup.x0-pts.x0)+(sup.x1-pts.x1)*(sup.x1-pts.x1)) d, lab.id nid from sup, pts join lab on lab.id = pts.id where lab.c >= 0),
        r as (select *, row_number() over (partition by id order by d, nid) rn from d)
        select sup.id as s_suppkey, case when d <= (select eps from eps) then c else -1 end as prediction from sup left join r on r.id = sup.id and rn = 1"""
    sql["cluster_summary"] = f"with recursive {DB} select count(distinct case when c >= 0 then c end) as clusters, count(*) filter (c = -1) as noise, count(*) as \"rows\" from lab"
    sql["pca_2d"] = f"""with recursive {PCA} select id as p_partkey, {r6('(x0-u0)*f.v0+(x1-u1)*f.v1')} as pc1, {r6('(x0-u0)*g.v0+(x1-u1)*g.v1')} as pc2 from pts, mu, f, g"""

    sql["eval_regression"] = f"""with recursive {LINEAR} select {r6('avg(abs(predicted-actual))')} as mae, {r6('sqrt(avg((predicted-actual)**2))')} as rmse,
        {r6('1 - sum((predicted-actual)**2)/case when var_pop(actual) = 0 then 1 else var_pop(actual)*count(*) end')} as r2, count(*) as "rows" from pred"""
    sql["eval_confusion"] = f"with {NB}, {CONFUSION} select * from cm"
    sql["confusion_view"] = f"with {NB}, {CONFUSION} select concat(a.event_type, ' -> ', b.event_type) as pair, n from cm join cls a on a.c = actual join cls b on b.c = predicted"
    sql["eval_class_metrics"] = f"with {NB}, {CLASS_METRICS} select c as class_index, {r6('pre')} as \"precision\", {r6('rec')} as recall, {r6('f1')} as f1 from f1"
    sql["eval_classification"] = f"""with {NB}, {CLASS_METRICS} select {r6('(select avg(case when label = pred then 1.0 else 0.0 end) from test)')} as accuracy,
        {r6('avg(f1)')} as macro_f1, count(*) as classes, (select count(*) from test) as "rows" from f1"""
    sql["importance_top8"] = f"""with {NB}, im as (select j, stddev_pop(m) s from par group by j)
        select cast(j as bigint) as position, case j when 0 then 'value' when 1 then 'user_id' else 'k' end as name, {r6('s')} as importance,
        cast(floor(s/(select max(s) from im)*100+0.5) as bigint) as percent from im order by s desc, j limit 8"""
    names = "case j when 0 then 'number' else 'p_size' end"
    sql["explain_signals"] = f"""with recursive {LINEAR}, lg as (select id, 0 j, x0 x, abs(c0) c from pred union all select id, 1, x1, abs(c1) from pred)
        select id as p_partkey, {names} as feature, {r6('c')} as contribution, case when x >= 0 then '{fixed.ABOVE}' else '{fixed.BELOW}' end as direction from lg where c > 0"""
    why, why_not = fixed.CLASS_WHY, fixed.CLASS_WHY_NOT
    sql["explain_class"] = f"""with {NB}, im as materialized (select j, stddev_pop(m) s from par group by j),
        rk as materialized (select pb.id, event_type, p, row_number() over (partition by pb.id order by p desc, pb.c) rn from pb join cls using (c)),
        sg as materialized (select z.id, string_agg(case j when 0 then 'value' when 1 then 'user_id' else 'k' end, '|' order by abs(x)*s desc, j) signals from z join im using (j) where abs(x)*s > 0 group by z.id)
        select a.id as event_id, concat('{fixed.CLASS_HEADLINE}', a.event_type) as headline,
        concat('{why[0]}', cast(cast(floor(a.p*100+0.5) as bigint) as varchar), '{why[1]}') as why,
        concat(b.event_type, '{why_not[0]}', cast(cast(floor(b.p*100+0.5) as bigint) as varchar), '{why_not[1]}') as why_not, signals
        from rk a join rk b on a.id = b.id and a.rn = 1 and b.rn = 2 join sg on sg.id = a.id join sp on sp.id = a.id where is_test"""
    def shown(v: str, digits: int) -> str:
        # Exact ties are found on the exact decimal, which the predictions are too long for to be one.
        return f"regexp_replace(printf('%.{digits}f', {v}), '\\.?0+$', '')"

    number = f"case when abs(predicted) >= 100 then {shown('predicted', 2)} else {shown('predicted', 3)} end"
    sql["explain_regression"] = f"""with recursive {LINEAR} select id as p_partkey, concat('{fixed.VALUE_HEADLINE}', {number}) as headline, {text(fixed.VALUE_WHY_LINEAR)} as why,
        {text(fixed.VALUE_WHY_NOT)} as why_not from pred"""
    sql["explain_cluster"] = f"""with recursive {DB} select id as c_custkey, concat('{fixed.CLUSTER_HEADLINE}', case when c = -1 then '{fixed.CLUSTER_NOISE}' else cast(c as varchar) end) as headline,
        case when c = -1 then {text(fixed.CLUSTER_WHY_NOISE)} else {text(fixed.CLUSTER_WHY)} end as why, {text(fixed.CLUSTER_WHY_NOT)} as why_not from lab"""
    sql["explain_kmeans"] = f"""with {KMEANS} select id as c_custkey, concat('{fixed.CLUSTER_HEADLINE}', cast(c as varchar)) as headline,
        {text(fixed.CLUSTER_WHY)} as why, {text(fixed.CLUSTER_WHY_NOT)} as why_not from a{last}"""
    strength = " union all ".join(
        f"select pt.id, {j} as j, '{n}' as name, abs(x{j} * (case pq.c {' '.join(f'when {c} then w{c}_{j + 1}' for c in range(5))} end)) as s from pt join pq on pq.id = pt.id and pq.rn = 1, w"
        for j, n in enumerate(("value", "user_id", "k"))
    )
    strong = f"select id, string_agg(name, '|' order by s desc, j) as signals from ({strength}) where s > 0 group by id"
    sql["explain_softmax"] = f"""with recursive {SOFTMAX} select a.id as event_id, concat('{fixed.CLASS_HEADLINE}', ca.event_type) as headline,
        concat('{why[0]}', cast(cast(floor(a.p*100+0.5) as bigint) as varchar), '{why[1]}') as why,
        concat(cb.event_type, '{why_not[0]}', cast(cast(floor(b.p*100+0.5) as bigint) as varchar), '{why_not[1]}') as why_not, signals
        from pq a join pq b on a.id = b.id and a.rn = 1 and b.rn = 2 join cls ca on ca.c = a.c join cls cb on cb.c = b.c join ({strong}) sg on sg.id = a.id"""
    tie = lambda v, e: f"case when abs({e}) >= 100 then {shown(f'round(({e})::decimal(24, 8), 2)', 2)} else {shown(f'round(({e})::decimal(24, 8), 3)', 3)} end as {v}"
    sql["format_ties"] = f"select o_orderkey, {tie('eighth', 'o_orderkey / 8')}, {tie('sixteenth', 'o_orderkey % 1600 / -16')} from orders"
    sql["profile_wide_ids"] = "select 'wide_id' as \"column\", count(distinct 9007199254740992 + o_orderkey) as \"unique\", 0 as missing from orders"
    sql["kmeans_many"] = f"with {POINTS}, {lloyd(KMEANS_MANY)} select id as c_custkey, c as prediction from a{last}"
    for large, plain in (("score_stream_clusters", "dbscan_predict"), ("quartiles_ranges", "quartiles"), ("row_id_ranges", "row_id_by_key"), ("knn_cells", "knn_neighbors"), ("knn_classify_cells", "knn_classify"), ("dbscan_star", "dbscan_labels"), ("dbscan_predict_cells", "dbscan_predict")):
        sql[large] = sql[plain]
    sql["score_batch"] = f"with {NB} select best.id as event_id, event_type as predicted_label from best join cls on cls.c = pred"
    sql["score_stored"] = sql["score_batch"]
    sql["softmax_fit"] = "with recursive " + SOFTMAX + " " + " union all ".join(
        f"select {c}::bigint as class_index, {j}::bigint as position, {r6(f'w{c}_{j}')} as weight from w" for c in range(5) for j in range(4)
    )
    sql["softmax_predict"] = f"""with recursive {SOFTMAX} select id as event_id, cast(y as double) as label, cast(c as double) as prediction, {r6('p')} as top_probability from pq where rn = 1"""
    sql["tree_classify"] = f"""with {class_trees()} select id as event_id, cast(y as double) as label, cast(c as double) as prediction, {r6('p')} as top_probability
        from at6 join sp using (id) join lab using (id) join lp using (tree, node) where is_test"""
    sql["tree_regress"] = f"""with {value_trees()} select id as p_partkey, {r6('y')} as label, {r6('s1/s0 + ym')} as prediction
        from at6 join sp using (id) join lab using (id) join leaf using (tree, node), tm where is_test"""
    sql["forest_classify"] = f"""with {class_trees(**CLASS_FOREST)}, vt as (select id, c, count(*)/{CLASS_FOREST['trees']}.0::double p from at7 join lp using (tree, node) group by 1, 2),
        bv as (select *, row_number() over (partition by id order by p desc, c) rn from vt)
        select id as event_id, cast(y as double) as label, cast(c as double) as prediction, {r6('p')} as top_probability from bv join lab using (id) join sp using (id) where is_test and rn = 1"""
    sql["forest_regress"] = f"""with {value_trees(**VALUE_FOREST)} select id as p_partkey, {r6('max(y)')} as label, {r6('avg(s1/s0 + ym)')} as prediction
        from at7 join sp using (id) join lab using (id) join leaf using (tree, node), tm where is_test group by id"""
    sql["score_stream_files"] = sql["score_batch"]
    return sql
