"""SQL text shared by the oracles: the derived views as common table expressions."""

NOTICES = """
b0 as (select o_orderkey k, o_custkey ck, o_orderdate d, concat(o_orderpriority, '/', o_orderstatus) ntype, n_name,
         cast(round(o_totalprice * 100) as bigint) cents
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
b1 as (select *, cast(cents // 100 as varchar) w, lpad(cast(cents % 100 as varchar), 2, '0') f from b0),
n as (select cast(k as varchar) notice_id, d publication_date, n_name country, ntype notice_type,
        case k % 13 when 0 then null when 1 then 'invalid' when 2 then concat('1,', w, '.', f)
          when 3 then concat(w, ',', f) when 4 then concat('EUR ', w, '.', f)
          when 5 then concat('-', w, '.', f) else concat(w, '.', f) end total_value,
        case k % 11 when 0 then 'EUR 1000' when 1 then 'SEK 1000' when 2 then 'BGN 1000' when 3 then 'NOK 1000'
          when 4 then 'PLN 1000' when 5 then 'CZK 1000' when 6 then 'HUF 1000' when 7 then 'DKK 1000'
          when 8 then 'RON 1000' when 9 then 'USD 1000' else null end est_cur,
        case ck % 6 when 0 then null when 1 then 'small|medium' when 2 then 'large' when 3 then 'micro'
          when 4 then 'sme|sme|small' else 'unknown' end winner_size
      from b1)"""

VALUED = (
    NOTICES
    + """,
m as (select *,
        case when est_cur like '%EUR%' then 'EUR' when est_cur like '%SEK%' then 'SEK'
          when est_cur like '%BGN%' then 'BGN' when est_cur like '%NOK%' then 'NOK'
          when est_cur like '%PLN%' then 'PLN' when est_cur like '%CZK%' then 'CZK'
          when est_cur like '%HUF%' then 'HUF' when est_cur like '%DKK%' then 'DKK'
          when est_cur like '%RON%' then 'RON' else 'EUR' end currency,
        try_cast(regexp_replace(replace(total_value, ',', '.'), '[^0-9.]', '', 'g') as double) amount
      from n),
e as (select *,
        amount * cast(case currency when 'SEK' then 0.087 when 'BGN' then 0.51 when 'NOK' then 0.086
          when 'PLN' then 0.23 when 'CZK' then 0.039 when 'HUF' then 0.0026 when 'DKK' then 0.13
          when 'RON' then 0.20 else 1.0 end as double) eur,
        case when winner_size is null then 0 else len(string_split(winner_size, '|')) end bidders,
        case when winner_size is not null then string_split(winner_size, '|')[1] end bidder_size
      from m)"""
)

FLAGGED = (
    VALUED
    + """,
p as (select quantile_cont(eur, 0.95) p95, max(eur) top from e),
c as (select e.*, p95, top, coalesce(eur > p95, false) is_outlier, round_even(eur / top, 4) score,
        case when eur is null then null when eur < p95 then eur else p95 end capped,
        ln(1 + coalesce(eur, 0)) log_eur
      from e, p)"""
)

RESULTS = (
    FLAGGED
    + """,
r as (select concat('run-', strftime(publication_date, '%Y')) run_id, notice_id, coalesce(eur, 0.0) value_eur, country,
        notice_type, cast(is_outlier as integer) is_outlier, coalesce(score, 0.0) anomaly_score
      from c),
r1 as (select run_id, substr(run_id, 5, 4) y, cast(substr(run_id, 5, 4) as integer) yn, count(*) record_count,
         cast(sum(is_outlier) as bigint) outlier_count from r group by run_id),
runs as (select run_id, case yn % 3 when 0 then 'isolation_forest' when 1 then 'dbscan' else 'kmeans' end model_type,
           case when yn % 4 <> 0 then concat('{"contamination":"0.05","year":"', y, '"}')
             when yn % 8 = 0 then 'not json' end parameters,
           concat(y, '-06-15 12:00:00') execution_date, record_count, outlier_count,
           outlier_count * 100.0 / record_count outlier_percentage, concat('orders of ', y) notes
         from r1)"""
)

FEATURES = (
    VALUED
    + """,
l as (select cast(l_orderkey as varchar) notice_id, round(sum(l_quantity), 6) quantity, round(sum(l_discount), 6) discount
      from lineitem group by 1),
f as (select e.notice_id, eur, ln(1 + coalesce(eur, 0)) log_eur, quantity, discount, bidders, notice_type, bidder_size
      from e left join l on e.notice_id = l.notice_id)"""
)

# Customers on standardised balance and nation.
POINTS = """
p as (select c_custkey id, c_nationkey nation,
        (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () x,
        (c_nationkey - avg(c_nationkey) over ()) / stddev_pop(c_nationkey) over () y
      from customer)"""

# The mean point of each region stands for a fitted centroid.
CENTROIDS = (
    POINTS
    + """,
g as (select n_regionkey cluster, avg(x) cx, avg(y) cy from p join nation on nation = n_nationkey group by 1),
d as (select id, x, y, cluster, sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) distance from p, g),
a as (select id, any_value(x) x, any_value(y) y, arg_min(cluster, (distance, cluster)) cluster, min(distance) distance
      from d group by id)"""
)


# Six numbers of a customer; those without orders count as 0.
SIX = tuple(f"f{i}" for i in range(6))
SIX_POINTS = (
    """
co as (select c_custkey id, c_acctbal v0, c_nationkey v1, count(o_orderkey) v2, coalesce(sum(o_totalprice), 0) v3,
         coalesce(max(o_totalprice), 0) v4, coalesce(min(o_totalprice), 0) v5
       from customer left join orders on o_custkey = c_custkey group by all),
p as (select id, """
    + ", ".join(f"(v{i} - avg(v{i}) over ()) / stddev_pop(v{i}) over () f{i}" for i in range(6))
    + " from co)"
)


def _distance(columns: tuple[str, ...]) -> str:
    return "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in columns) + ")"


def pairs(eps: float, name: str = "n", columns: tuple[str, ...] = ("x", "y")) -> str:
    """All pairs of points within eps, self included."""
    return f"""
{name} as (select a.id i, b.id j from p a join p b on {_distance(columns)} <= {eps})"""


def dbscan(eps: float, min_samples: int, points: str = POINTS, columns: tuple[str, ...] = ("x", "y")) -> str:
    """Labels ``lab(id, cluster)`` of the points; needs ``with recursive``."""
    return (
        points
        + ","
        + pairs(eps, columns=columns)
        + f""",
core as (select i from n group by i having count(*) >= {min_samples}),
ed as (select n.i, n.j from n join core c on n.i = c.i join core k on n.j = k.i),
rc as (select i, i as root from core union select ed.j, rc.root from rc join ed on rc.i = ed.i),
comp as (select i, min(root) root from rc group by i),
cl as (select i, dense_rank() over (order by root) - 1 c from comp),
bd as (select n.i, min(cl.c) c from n join cl on n.j = cl.i group by n.i),
lab as (select p.*, cast(coalesce(cl.c, bd.c, -1) as bigint) cluster
        from p left join cl on p.id = cl.i left join bd on p.id = bd.i)"""
    )


def knn(k: int, columns: tuple[str, ...] = ("x", "y")) -> str:
    """``kn(id, rank, distance)`` of the k nearest points, itself included."""
    return f"""
kd as (select a.id, b.id other, {_distance(columns)} distance from p a, p b),
kr as (select id, distance, row_number() over (partition by id order by distance, other) as rank from kd),
kn as (select * from kr where rank <= {k})"""


def silhouette(labelled: str) -> str:
    """``sil(v)``: mean silhouette of ``labelled(id, x, y, cluster)``."""
    return f"""
sz as (select cluster, count(*) m from {labelled} group by cluster),
sd as (select a.id, a.cluster, b.cluster other, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) t
       from {labelled} a, {labelled} b group by 1, 2, 3),
sa as (select sd.id,
         max(case when sd.other = sd.cluster and m > 1 then t / (m - 1) end) a,
         min(case when sd.other <> sd.cluster then t / m end) b
       from sd join sz on sd.other = sz.cluster group by sd.id),
sil as (select coalesce(avg(case when a is null or b is null then 0 else (b - a) / greatest(a, b) end), 0) v from sa)"""


def select(base: str, body: str, *more: str) -> str:
    """A whole statement: the base views, further ones, and the body."""
    return "with recursive " + ", ".join([base.strip(), *more]) + "\n" + body
