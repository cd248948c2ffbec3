"""Independent DuckDB SQL for every SQL-expressible query in ``__spark_entry__``.

Each oracle is one statement: the fixture views of FIXTURES.md (and any intermediate
step) are emitted as CTEs, in dependency order, in front of the final SELECT. Nothing
here imports the engine: this is the check, written from the contract only.

Hash order H(x): first 8 hex digits of md5(x) as BIGINT.
"""

from __future__ import annotations

_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def view(name: str, sql: str, *deps: str) -> None:
    _VIEWS[name] = (sql.strip(), deps)


def H(expr: str) -> str:
    return f"cast('0x' || substr(md5({expr}), 1, 8) as bigint)"


def compose(final: str, *deps: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _VIEWS[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return final.strip()
    ctes = ",\n".join(f"{n} AS (\n{_VIEWS[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{final.strip()}"


# --- Fixture views (FIXTURES.md part 2) ------------------------------------------------
view("users", "select c_mktsegment as category, c_custkey as user_id, c_name as mail_id from customer")
view(
    "catalog",
    """select s.category, p_partkey as product_id, p_name || ' #' || cast(p_partkey as varchar) as product_name,
       p_brand as manufacturer
       from part cross join (select distinct c_mktsegment as category from customer) s""",
)
view("products", "select * from catalog where product_id % 10 <> 0", "catalog")
view("new_products", "select * from catalog where product_id % 10 = 0", "catalog")
view(
    "fx_all_ratings",
    """select c_mktsegment as category, o_custkey as user_id, l_partkey as product_id,
       1.0e0 + (cast(l_quantity as int) % 5) as rating
       from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       where l_returnflag = 'R'""",
)
view("ratings", "select * from fx_all_ratings where product_id % 10 <> 0", "fx_all_ratings")
view("new_product_ratings", "select * from fx_all_ratings where product_id % 10 = 0", "fx_all_ratings")
view(
    "shown",
    """select n.category, n.product_name from events join customer on user_id = c_custkey
       join new_products n on n.category = c_mktsegment
        and n.product_id = 10 * cast(json_extract_string(props, '$.k') as bigint)
       where event_type = 'view'""",
    "new_products",
)
view(
    "user_requests",
    """select category, mail_id from users union all select category, 'guest-' || mail_id from users""",
    "users",
)
view(
    "product_requests",
    """select category, product_name, manufacturer from catalog
       union all select category, 'fresh ' || product_name, manufacturer from catalog""",
    "catalog",
)
view(
    "feedback",
    """select c_mktsegment as category, o_custkey as user_id,
       p_name || ' #' || cast(p_partkey as varchar) as product_name,
       case when cast(l_quantity as int) % 13 = 0 then 9.0e0 else 1.0e0 + (cast(l_quantity as int) % 5) end as rating,
       o_orderkey as seq
       from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join part on p_partkey = l_partkey
       where l_returnflag = 'A'""",
)
view(
    "history",
    """select c_mktsegment as category, o_custkey as user_id, o_orderkey as batch_id,
       string_agg(p_name || ' #' || cast(p_partkey as varchar), ':' order by l_linenumber, l_partkey, l_quantity) as product_list
       from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
       join part on p_partkey = l_partkey
       where l_returnflag = 'N' group by 1, 2, 3""",
)
view(
    "user_recs",
    """select category, user_id, product_id, rating as score from (
         select *, row_number() over (partition by category, user_id order by rating desc, product_id) rn
         from (select category, user_id, product_id, max(rating) rating from ratings group by all))
       where rn <= 3""",
    "ratings",
)
# stage thresholds of the batch: second and fourth smallest rating count of the categories
view(
    "thresholds",
    """select list_sort(list(n))[2] as t1, list_sort(list(n))[4] as t2
       from (select category, count(*) as n from fx_all_ratings group by 1)""",
    "fx_all_ratings",
)
view(
    "mean_predictions",
    """select r.category, r.user_id, r.product_id, r.rating, m.prediction from ratings r
       join (select category, product_id, avg(rating) as prediction from fx_all_ratings group by 1, 2) m
       on m.category = r.category and m.product_id = r.product_id""",
    "ratings",
    "fx_all_ratings",
)
view(
    "raw_rating_lines",
    """select category, case
         when product_id % 17 = 0 then cast(user_id as varchar) || ',' || cast(product_id as varchar)
         when product_id % 19 = 0 then cast(user_id as varchar) || ',x,' || cast(cast(rating as int) as varchar)
         else cast(user_id as varchar) || ',' || cast(product_id as varchar) || ',' || cast(cast(rating as int) as varchar)
       end as line from ratings""",
    "ratings",
)

# --- Steps of the contract, per snapshot ------------------------------------------------
def snapshot(p: str, ratings: str, new_ratings: str) -> None:
    """Views over one snapshot: prefix ``p``; products and shown are the fixture ones."""
    view(
        f"{p}all_ratings",
        f"""select category, user_id, product_id, rating from {ratings}
            union all select category, user_id, product_id, rating from {new_ratings}""",
        ratings, new_ratings,
    )
    view(
        f"{p}mean_ratings",
        f"""select category, product_id, avg(rating) as mean_rating, count(*) as n_ratings
            from {p}all_ratings group by 1, 2""",
        f"{p}all_ratings",
    )
    view(
        f"{p}category_top",
        f"""select t.category, t.rank, t.product_id, a.product_name, t.mean_rating from (
              select category, product_id, mean_rating,
                     row_number() over (partition by category order by mean_rating desc, product_id) as rank
              from {p}mean_ratings) t
            join all_products a on a.category = t.category and a.product_id = t.product_id
            where t.rank <= 5""",
        f"{p}mean_ratings", "all_products",
    )
    view(
        f"{p}stage",
        f"""select d.category, coalesce(c.n, 0)::bigint as n_ratings,
              (case when coalesce(c.n, 0) < t1 then 1 when coalesce(c.n, 0) < t2 then 2 else 3 end)::bigint as stage
            from thresholds, (select category from users union select category from products
                  union select category from new_products) d
            left join (select category, count(*) as n from {p}all_ratings group by 1) c
              on c.category = d.category""",
        "users", "products", "new_products", "thresholds", f"{p}all_ratings",
    )
    view(
        f"{p}top_rated_new",
        f"""select t.category, t.rank, t.product_id, n.product_name, t.mean_rating from (
              select category, product_id, avg(rating) as mean_rating,
                     row_number() over (partition by category order by avg(rating) desc, product_id) as rank
              from {new_ratings} group by 1, 2) t
            join new_products n on n.category = t.category and n.product_id = t.product_id
            where t.rank <= 2""",
        new_ratings, "new_products",
    )
    view(
        f"{p}least_shown_unrated",
        f"""select * from (
              select n.category, n.product_id, n.product_name, coalesce(s.n_shown, 0)::bigint as n_shown,
                     row_number() over (partition by n.category order by coalesce(s.n_shown, 0), n.product_id) as rank
              from new_products n
              left join (select category, product_name, count(*) as n_shown from shown group by 1, 2) s
                on s.category = n.category and s.product_name = n.product_name
              where not exists (select 1 from {new_ratings} r
                                where r.category = n.category and r.product_id = n.product_id))
            where rank <= 4""",
        "new_products", "shown", new_ratings,
    )


def strategies(p: str, o: str, users: str) -> None:
    """Recommendation strategies over snapshot ``p`` for the users of view ``users``;
    output views are prefixed ``o``."""
    key = lambda a, b: f"{a}.category = {b}.category and {a}.user_id = {b}.user_id"
    view(
        f"{o}initial",
        f"""select u.category, u.user_id, t.i::bigint as slot, np.product_id, np.product_name,
                   'sample' as source
            from {users} u
            join (select category, count(*) as size from new_products group by 1) s on s.category = u.category
            cross join range(0, 5) t(i)
            join (select category, product_id, product_name,
                         row_number() over (partition by category order by
                           {H("'42|' || category || '|' || cast(product_id as varchar)")}, product_id) - 1 as pos
                  from new_products) np
              on np.category = u.category
             and np.pos = ({H("'42|' || u.category || '|' || cast(u.user_id as varchar)")} % s.size + t.i) % s.size
            where t.i < least(5, s.size)""",
        users, "new_products",
    )
    picks = []
    for pool, slot, src in (("least_shown_unrated", 0, "new_unrated"), ("top_rated_new", 1, "new_rated")):
        salt = "unrated" if slot == 0 else "rated"
        picks.append(
            f"""select u.category, u.user_id, {slot}::bigint as slot, x.product_id, x.product_name,
                       '{src}' as source
                from {users} u
                join (select category, count(*) as size from {p}{pool} group by 1) s on s.category = u.category
                join {p}{pool} x on x.category = u.category
                 and x.rank = {H(f"'42|{salt}|' || u.category || '|' || cast(u.user_id as varchar)")} % s.size + 1"""
        )
    view(f"{o}new_recs", "\nunion all\n".join(picks), users, f"{p}least_shown_unrated", f"{p}top_rated_new")
    view(
        f"{o}mid",
        f"""select category, user_id,
                   (row_number() over (partition by category, user_id order by slot) - 1)::bigint as slot,
                   product_id, product_name, source
            from (select category, user_id, product_id, min(slot) as slot,
                         arg_min(product_name, slot) as product_name, arg_min(source, slot) as source
                  from (select u.category, u.user_id, (c.rank - 1)::bigint as slot, c.product_id,
                               c.product_name, 'category' as source
                        from {users} u join {p}category_top c on c.category = u.category where c.rank <= 3
                        union all
                        select category, user_id, slot + 3, product_id, product_name, source from {o}new_recs)
                  group by 1, 2, 3)""",
        users, f"{p}category_top", f"{o}new_recs",
    )
    view(
        f"{o}als",
        f"""select t.category, t.user_id, (t.rank - 1)::bigint as slot, t.product_id, a.product_name,
                   'als' as source
            from (select r.category, r.user_id, r.product_id,
                         row_number() over (partition by r.category, r.user_id order by r.score desc, r.product_id) as rank
                  from user_recs r
                  where exists (select 1 from {users} u where {key('u', 'r')})
                    and exists (select 1 from {p}all_ratings x where {key('x', 'r')})) t
            join all_products a on a.category = t.category and a.product_id = t.product_id
            where t.rank <= 3""",
        users, "user_recs", f"{p}all_ratings", "all_products",
    )
    view(
        f"{o}final",
        f"""select * from {o}als
            union all
            select u.category, u.user_id, (c.rank - 1)::bigint as slot, c.product_id, c.product_name,
                   'category' as source
            from {users} u join {p}category_top c on c.category = u.category
            where not exists (select 1 from {o}als a where {key('a', 'u')})""",
        f"{o}als", users, f"{p}category_top",
    )


def dispatch(p: str, o: str, users: str) -> None:
    """Strategies by stage for the users of view ``users`` over snapshot ``p``."""
    for st in (1, 2, 3):
        view(
            f"{o}u{st}",
            f"""select u.category, u.user_id from {users} u join {p}stage s on s.category = u.category
                where s.stage = {st}""",
            users, f"{p}stage",
        )
        strategies(p, f"{o}s{st}_", f"{o}u{st}")
    view(
        f"{o}recommend",
        f"""select *, 1::bigint as stage from {o}s1_initial
            union all select *, 2::bigint from {o}s2_mid
            union all select *, 3::bigint from {o}s3_final""",
        f"{o}s1_initial", f"{o}s2_mid", f"{o}s3_final",
    )


view(
    "all_products",
    """select category, product_id, product_name, manufacturer, false as is_new from products
       union all select category, product_id, product_name, manufacturer, true from new_products""",
    "products", "new_products",
)
snapshot("", "ratings", "new_product_ratings")
strategies("", "", "users")
dispatch("", "st_", "users")

view(
    "product_ids",
    """select category, product_name, product_id, is_new from (
         select *, row_number() over (partition by category, product_name order by is_new, product_id) as rn
         from all_products) where rn = 1""",
    "all_products",
)
view(
    "assign_user_ids",
    """select n.category, (coalesce(m.mx, 0) + row_number() over (partition by n.category order by n.mail_id))::bigint as user_id,
              n.mail_id
       from (select distinct category, mail_id from user_requests r
             where not exists (select 1 from users u where u.category = r.category and u.mail_id = r.mail_id)) n
       left join (select category, max(user_id) as mx from users group by 1) m on m.category = n.category""",
    "user_requests", "users",
)
view(
    "assign_product_ids",
    """select n.category, (coalesce(m.mx, 0) + row_number() over (partition by n.category order by n.product_name))::bigint as product_id,
              n.product_name
       from (select distinct category, product_name from product_requests r
             where not exists (select 1 from all_products a
                               where a.category = r.category and a.product_name = r.product_name)) n
       left join (select category, max(product_id) as mx from all_products group by 1) m on m.category = n.category""",
    "product_requests", "all_products",
)
view(
    "promotion_list",
    """select category, product_id, count(*) as n_ratings from new_product_ratings
       group by 1, 2 having count(*) > 2""",
    "new_product_ratings",
)
for _name, _src, _neg in (
    ("promoted_products", "new_products", ""), ("promoted_ratings", "new_product_ratings", ""),
    ("remaining_new_products", "new_products", "not "), ("remaining_new_ratings", "new_product_ratings", "not "),
):
    view(
        _name,
        f"""select * from {_src} x where {_neg}exists (select 1 from promotion_list p
            where p.category = x.category and p.product_id = x.product_id)""",
        _src, "promotion_list",
    )
view(
    "feedback_batch",
    """select category, user_id, product_name, rating, seq from (
         select *, row_number() over (partition by category, user_id, product_name order by seq desc, rating desc) as rn
         from feedback) where rn = 1""",
    "feedback",
)
view(
    "route_feedback",
    """select f.category, f.user_id, f.product_name, f.product_id, f.rating, f.seq,
              case when f.reason is not null then 'rejected'
                   when n.product_name is not null then 'new_product_ratings' else 'ratings' end as target,
              f.reason
       from (select b.*, i.product_id,
                    case when i.product_id is null then 'unknown_product'
                         when b.rating is null or isnan(b.rating) then 'missing_rating'
                         when b.rating < 0 or b.rating > 5 then 'out_of_range' end as reason
             from feedback_batch b left join product_ids i
               on i.category = b.category and i.product_name = b.product_name) f
       left join (select distinct category, product_name from new_products) n
         on n.category = f.category and n.product_name = f.product_name""",
    "feedback_batch", "product_ids", "new_products",
)


def flag(requests: str, cols: list[str], keys: str, name: str) -> str:
    on = " and ".join(f"k.{c} = r.{c}" for c in cols)
    sel = ", ".join(f"r.{c}" for c in cols)
    return f"""select {sel}, (k.{cols[0]} is not null) as {name} from {requests} r
               left join (select distinct {", ".join(cols)} from {keys}) k on {on}"""


LONG = "category, product_id, product_name, manufacturer, user_id, rating"
ORACLES: dict[str, str] = {
    "all_products": compose("select * from all_products", "all_products"),
    "all_ratings": compose("select * from all_ratings", "all_ratings"),
    "mean_ratings": compose("select * from mean_ratings", "mean_ratings"),
    "category_top": compose("select * from category_top", "category_top"),
    "category_top_mid": compose("select * from category_top where rank <= 3", "category_top"),
    "new_product_means": compose(
        """select category, product_id, avg(rating) as mean_rating, count(*) as n_ratings
           from new_product_ratings group by 1, 2""", "new_product_ratings"),
    "distinct_raters": compose("select distinct category, user_id from ratings", "ratings"),
    "rated_new_products": compose(
        "select distinct category, product_id from new_product_ratings", "new_product_ratings"),
    "category_stage": compose("select * from stage", "stage"),
    "product_mean_rating": compose(
        """select a.category, a.product_id, coalesce(m.mean_rating, 0.0) as mean_rating
           from all_products a left join mean_ratings m
             on m.category = a.category and m.product_id = a.product_id""",
        "all_products", "mean_ratings"),
    "user_exists": compose(flag("user_requests", ["category", "mail_id"], "users", "user_exists"),
                           "user_requests", "users"),
    "lookup_user_id": compose(
        """select r.category, r.mail_id, u.user_id from user_requests r
           join (select category, mail_id, min(user_id) as user_id from users group by 1, 2) u
             on u.category = r.category and u.mail_id = r.mail_id""", "user_requests", "users"),
    "assign_user_ids": compose("select * from assign_user_ids", "assign_user_ids"),
    "register_users": compose(
        """select category, user_id, mail_id from users
           union all select category, user_id, mail_id from assign_user_ids""",
        "users", "assign_user_ids"),
    "product_exists": compose(
        flag("product_requests", ["category", "product_name"], "all_products", "product_exists"),
        "product_requests", "all_products"),
    "lookup_product_id": compose(
        """select r.category, r.product_name, i.product_id, i.is_new from product_requests r
           join product_ids i on i.category = r.category and i.product_name = r.product_name""",
        "product_requests", "product_ids"),
    "assign_product_ids": compose("select * from assign_product_ids", "assign_product_ids"),
    "onboard_products": compose(
        """select a.category, a.product_id, a.product_name, m.manufacturer from assign_product_ids a
           join (select category, product_name, min(manufacturer) as manufacturer
                 from product_requests group by 1, 2) m
             on m.category = a.category and m.product_name = a.product_name""",
        "assign_product_ids", "product_requests"),
    "product_is_new": compose(
        flag("product_requests", ["category", "product_name"], "new_products", "is_new"),
        "product_requests", "new_products"),
    "product_names": compose(
        """select r.category, r.product_id, r.user_id, r.score, a.product_name from user_recs r
           join all_products a on a.category = r.category and a.product_id = r.product_id""",
        "user_recs", "all_products"),
    "has_ratings": compose(flag("users", ["category", "user_id"], "all_ratings", "has_ratings"),
                           "users", "all_ratings"),
    "shown_counts": compose(
        "select category, product_name, count(*) as n_shown from shown group by 1, 2", "shown"),
    "promotion_list": compose("select * from promotion_list", "promotion_list"),
    "promoted_products": compose("select * from promoted_products", "promoted_products"),
    "promoted_ratings": compose("select * from promoted_ratings", "promoted_ratings"),
    "remaining_new_products": compose("select * from remaining_new_products", "remaining_new_products"),
    "remaining_new_ratings": compose("select * from remaining_new_ratings", "remaining_new_ratings"),
    "promote_products": compose(
        f"""select 'new_product_ratings' as table_name, category, product_id, null::varchar as product_name,
                   null::varchar as manufacturer, user_id, rating from remaining_new_ratings
            union all select 'new_products', category, product_id, product_name, manufacturer,
                   null::bigint, null::double from remaining_new_products
            union all select 'products', category, product_id, product_name, manufacturer,
                   null::bigint, null::double
                   from (select * from products union all select * from promoted_products)
            union all select 'ratings', category, product_id, null::varchar, null::varchar, user_id, rating
                   from (select * from ratings union all select * from promoted_ratings)""",
        "remaining_new_ratings", "remaining_new_products", "products", "promoted_products",
        "ratings", "promoted_ratings"),
    "top_rated_new": compose("select * from top_rated_new", "top_rated_new"),
    "least_shown_unrated": compose("select * from least_shown_unrated", "least_shown_unrated"),
    "sample_new": compose("select * from initial", "initial"),
    "sample_new_stored": compose("select * from initial", "initial"),
    "new_product_recs": compose("select * from new_recs", "new_recs"),
    "initial_recs": compose("select * from initial", "initial"),
    "mid_recs": compose("select * from mid", "mid"),
    "final_recs": compose("select * from final", "final"),
    "recommend": compose("select * from st_recommend", "st_recommend"),
    "feedback_batch": compose("select * from feedback_batch", "feedback_batch"),
    "route_feedback": compose("select * from route_feedback", "route_feedback"),
    "last_recommendations": compose(
        """select category, user_id, batch_id,
                  (generate_subscripts(string_split(product_list, ':'), 1) - 1)::bigint as slot,
                  unnest(string_split(product_list, ':')) as product_name
           from (select category, user_id, max(batch_id) as batch_id,
                        arg_max(product_list, batch_id) as product_list
                 from history group by 1, 2)""", "history"),
    "push_recommendations": compose(
        """select category, user_id, 0::bigint as batch_id,
                  string_agg(product_name, ':' order by slot) as product_list
           from final group by 1, 2""", "final"),
}

view(
    "est_top",
    """select t.category, t.rank, t.product_id, a.product_name, t.mean_rating from (
         select category, product_id, avg(rating) as mean_rating,
                row_number() over (partition by category order by avg(rating) desc, product_id) as rank
         from ratings group by 1, 2) t
       join all_products a on a.category = t.category and a.product_id = t.product_id
       where t.rank <= 5""",
    "ratings", "all_products",
)
view(
    "parsed_lines",
    """select category, line,
              case when len(parts) = 3 then try_cast(trim(parts[1]) as bigint) end as user_id,
              case when len(parts) = 3 then try_cast(trim(parts[2]) as bigint) end as product_id,
              case when len(parts) = 3 then try_cast(trim(parts[3]) as double) end as rating,
              len(parts) = 3 as three
       from (select category, line, string_split(line, ',') as parts from raw_rating_lines)""",
    "raw_rating_lines",
)

# Registrations and feedback of the batch first, then one snapshot for every list
view("j_rq", "select distinct category, mail_id from user_requests", "user_requests")
view(
    "j_known",
    """select r.category, r.mail_id, u.user_id from j_rq r
       join (select category, mail_id, min(user_id) as user_id from users group by 1, 2) u
         on u.category = r.category and u.mail_id = r.mail_id""",
    "j_rq", "users",
)
view(
    "j_req_users",
    """select category, mail_id, user_id from j_known
       union all select category, mail_id, user_id from assign_user_ids""",
    "j_known", "assign_user_ids",
)
view("j_users", "select distinct category, user_id from j_req_users", "j_req_users")
view(
    "j_feedback",
    """select category, user_id, product_name, rating, seq from (
         select f.*, row_number() over (partition by f.category, f.user_id, f.product_name
                                        order by f.seq desc, f.rating desc) as rn
         from feedback f)
       where rn = 1""",
    "feedback",
)
view(
    "j_routed",
    """select b.category, b.user_id, b.product_name, i.product_id, b.rating,
              case when not exists (select 1 from users u where u.category = b.category and u.user_id = b.user_id) then 'unknown_user'
                   when i.product_id is null then 'unknown_product'
                   when b.rating is null or isnan(b.rating) then 'missing_rating'
                   when b.rating < 0 or b.rating > 5 then 'out_of_range' end as reason,
              case when not exists (select 1 from users u where u.category = b.category and u.user_id = b.user_id)
                        or i.product_id is null or b.rating is null or isnan(b.rating)
                        or b.rating < 0 or b.rating > 5 then 'rejected'
                   when exists (select 1 from new_products n
                                where n.category = b.category and n.product_name = b.product_name)
                   then 'new_product_ratings' else 'ratings' end as target
       from j_feedback b left join product_ids i
         on i.category = b.category and i.product_name = b.product_name""",
    "j_feedback", "product_ids", "new_products", "users",
)
view(
    "j_ratings",
    """select category, user_id, product_id, rating from ratings
       union all select category, user_id, product_id, rating from j_routed where target = 'ratings'""",
    "ratings", "j_routed",
)
view(
    "j_new_ratings",
    """select category, user_id, product_id, rating from new_product_ratings
       union all select category, user_id, product_id, rating from j_routed
       where target = 'new_product_ratings'""",
    "new_product_ratings", "j_routed",
)
snapshot("j_", "j_ratings", "j_new_ratings")
dispatch("j_", "j_", "j_users")

ORACLES.update({
    "scan_category": compose("select * from products where category = 'BUILDING'", "products"),
    "parse_ratings": compose(
        """select q.category, q.line, q.user_id, q.product_id, q.rating,
                  case when not q.three then 'fields'
                       when q.user_id is null or q.product_id is null or q.rating is null then 'not_a_number'
                       when q.rating < 0 or q.rating > 5 then 'out_of_range'
                       when k.product_id is null then 'unknown_product' end as error
           from parsed_lines q left join (select distinct category, product_id from all_products) k
             on k.category = q.category and k.product_id = q.product_id""",
        "parsed_lines", "all_products"),
    "legacy_import": compose(
        """select q.category, q.user_id, q.product_id, q.rating
           from parsed_lines q join (select distinct category, product_id from all_products) k
             on k.category = q.category and k.product_id = q.product_id
           where q.three and q.user_id is not null and q.product_id is not null
             and q.rating is not null and q.rating between 0 and 5""",
        "parsed_lines", "all_products"),
    "sink_append": compose("select * from users union all select * from users", "users"),
    "sink_overwrite": compose(
        """select t.* from category_top t join stage s on s.category = t.category and s.stage = 3
           union all select e.* from est_top e join stage s on s.category = e.category and s.stage < 3""",
        "category_top", "stage", "est_top"),
    "promote_job": ORACLES["promote_products"],
    "categorical_job": ORACLES["category_top"],
    "onboard_job": compose(
        """select * from new_products
           union all select a.category, a.product_id, a.product_name, m.manufacturer
           from assign_product_ids a
           join (select category, product_name, min(manufacturer) as manufacturer
                 from product_requests group by 1, 2) m
             on m.category = a.category and m.product_name = a.product_name""",
        "new_products", "assign_product_ids", "product_requests"),
    "recommend_job": compose(
        """select r.category, r.mail_id, r.user_id, x.slot, x.product_id, x.product_name, x.source, x.stage
           from j_recommend x join j_req_users r on r.category = x.category and r.user_id = x.user_id""",
        "j_recommend", "j_req_users"),
    "recommend_job_tables": compose(
        """select * from (
             select 'users' as table_name, category, user_id, mail_id, null::bigint as product_id, null::varchar as product_name,
                    null::double as rating, null::varchar as reason, null::bigint as batch_id, null::varchar as product_list
             from (select category, user_id, mail_id from users union all select category, user_id, mail_id from assign_user_ids)
             union all select 'ratings', category, user_id, null, product_id, null, rating, null, null, null from j_ratings
             union all select 'new_product_ratings', category, user_id, null, product_id, null, rating, null, null, null from j_new_ratings
             union all select 'feedback_rejects', category, user_id, null, product_id, product_name, rating, reason, 1, null
                       from j_routed where target = 'rejected'
             union all select 'previous_user_recommendations', category, user_id, null, null, null, null, null, batch_id, product_list from (
                       select category, user_id, batch_id, product_list from history
                       union all select category, user_id, 1, string_agg(product_name, ':' order by slot) from j_recommend group by 1, 2)
             union all select 'new_product_shown_list', category, null, null, null, product_name, null, null, null, null from (
                       select category, product_name from shown
                       union all select category, product_name from j_recommend where starts_with(source, 'new_')))""",
        "users", "assign_user_ids", "j_ratings", "j_new_ratings", "j_routed", "history", "j_recommend", "shown"),
    "train_validate_split": compose(
        f"""select *, case when {H("'0|' || category || '|' || cast(user_id as varchar) || '|' || cast(product_id as varchar)")} % 1000 < 700
                          then 'train' else 'validate' end as split
            from ratings""", "ratings"),
    "rmse": compose(
        """select category, round(sqrt(avg(power(rating - prediction, 2))), 6) as rmse,
                  count(*) as n_scored
           from mean_predictions group by 1""", "mean_predictions"),
})


# --- ALS: what does not depend on the solver's floats -----------------------------------------
view("split", f"""select *, case when {H("'0|' || category || '|' || cast(user_id as varchar) || '|' || cast(product_id as varchar)")} % 1000 < 700
       then 'train' else 'validate' end as split from ratings""", "ratings")
view(
    "predictable",
    """select v.category, v.user_id, v.product_id, v.rating from split v
       where v.split = 'validate'
         and exists (select 1 from split t where t.split = 'train' and t.category = v.category and t.user_id = v.user_id)
         and exists (select 1 from split t where t.split = 'train' and t.category = v.category and t.product_id = v.product_id)""",
    "split",
)
view(
    "grid",
    """select (row_number() over (order by r.i, g.i) - 1)::bigint as grid_index, r.v::bigint as rank, g.v as reg_param
       from (select unnest([5, 10, 15, 20]) as v, generate_subscripts([5, 10, 15, 20], 1) as i) r,
            (select unnest([0.001e0, 0.003e0, 0.009e0, 0.01e0, 0.03e0, 0.09e0, 0.1e0]) as v,
                    generate_subscripts([1, 2, 3, 4, 5, 6, 7], 1) as i) g""",
)
ORACLES.update({
    "als_train_digest": compose(
        """select 'user' as kind, category, user_id as id, 5::bigint as rank from (select distinct category, user_id from split where split = 'train')
           union all select 'item', category, product_id, 5::bigint from (select distinct category, product_id from split where split = 'train')""",
        "split"),
    "als_predict_digest": compose("select *, true as scored from predictable", "predictable"),
    "als_save_load": compose("select *, true as same from predictable", "predictable"),
    "als_grid_digest": compose(
        """select p.category, g.grid_index, g.rank, g.reg_param, p.n as n_scored, 1::bigint as n_winners, true as winner_is_lowest
           from (select category, count(*) as n from predictable group by 1) p, grid g""", "predictable", "grid"),
    "als_recommend_exact": compose(
        """select * from (
             select u.category, u.user_id, i.product_id,
                    ((u.user_id % 7 - 3) * (i.product_id % 13 - 6) + (u.user_id * 3 % 5 - 2) * (i.product_id * 5 % 7 - 3)
                     + (u.user_id % 11 - 5) * (i.product_id % 3 - 1))::double as score,
                    row_number() over (partition by u.category, u.user_id order by
                     (u.user_id % 7 - 3) * (i.product_id % 13 - 6) + (u.user_id * 3 % 5 - 2) * (i.product_id * 5 % 7 - 3)
                     + (u.user_id % 11 - 5) * (i.product_id % 3 - 1) desc, i.product_id) as rank
             from (select distinct category, user_id from ratings) u
             join (select distinct category, product_id from ratings) i on i.category = u.category)
           where rank <= 3""", "ratings"),
    "mf_job_digest": compose(
        """select u.category, u.user_id, least(3, i.n)::bigint as n_products, least(3, i.n)::bigint as n_distinct
           from (select distinct category, user_id from split where split = 'train') u
           join (select category, count(distinct product_id) as n from split where split = 'train' group by 1) i on i.category = u.category""",
        "split"),
})
ORACLES["als_recommend_blocks"] = ORACLES["als_recommend_exact"]
ORACLES["als_groups_digest"] = ORACLES["als_train_digest"]
ORACLES["last_recommendations_stored"] = ORACLES["last_recommendations"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
