"""The same results in plain SQL over the given tables, for the queries SQL can say."""

from __future__ import annotations

from tidemill.functions.html import BLOCK_TAGS, DROPPED_TAGS
from tidemill.operators.links import NAMESPACE
from tidemill.functions.text import JUNK_WORDS, ROLE_RULES

_WS = r"E' \t\n\r'"
_ATTRS = r"""(?:[^>"'']|"[^"]*"|''[^'']*'')*"""
_WORD = r"\p{L}\p{N}\p{M}_"
AS_OF = "timestamp '2024-01-03'"
EVENTS_AS_OF = "timestamp '2024-01-20'"


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def decode(x: str) -> str:
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        x = f"replace({x}, '{entity}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def without_elements(x: str, tags=DROPPED_TAGS) -> str:
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"
    for tag in tags:
        x = rf"regexp_replace({x}, '(?is)<{tag}{_ATTRS}>.*?</{tag}\s*>', chr(1), 'g')"
    return x


def stripped(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda x: {strip('x')}), lambda x: x <> '')"


def clean_text(html: str) -> str:
    marked = rf"regexp_replace({without_elements(html)}, '<[a-zA-Z/!?]{_ATTRS}>', chr(1), 'g')"
    return f"array_to_string({stripped(f'string_split({decode(marked)}, chr(1))')}, ' ')"


def main_text(html: str) -> str:
    region = rf"regexp_extract({without_elements(html)}, '(?is)<article>(.*)</article\s*>', 1)"
    marked = rf"regexp_replace({region}, '(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/][^>]*)?>', chr(1), 'g')"
    text = decode(rf"regexp_replace({marked}, '<[a-zA-Z/!?]{_ATTRS}>', '', 'g')")
    kept = f"list_filter(string_split({text}, chr(1)), lambda x: length(x) >= 20)"
    return f"nullif(array_to_string({stripped(kept)}, chr(10)), '')"


def region_text(html: str) -> str:
    """The ``main`` region or the whole page, without short blocks and blocks made mostly of links."""
    body = without_elements(html)
    region = rf"coalesce(nullif(regexp_extract({body}, '(?is)<main>(.*)</main\s*>', 1), ''), {body})"
    marked = rf"regexp_replace({region}, '(?i)</?(?:{'|'.join(BLOCK_TAGS)})(?:[\s/][^>]*)?>', chr(1), 'g')"
    marked = rf"regexp_replace(regexp_replace({marked}, '(?i)<a(?:\s[^>]*)?>', chr(2), 'g'), '(?i)</a\s*>', chr(3), 'g')"
    blocks = rf"string_split(regexp_replace({marked}, '<[a-zA-Z/!?]{_ATTRS}>', '', 'g'), chr(1))"
    text = lambda x: decode(f"replace(replace({x}, chr(2), ''), chr(3), '')")
    bare = decode("regexp_replace(x, chr(2) || '[^' || chr(3) || ']*' || chr(3), '', 'g')")
    kept = f"list_filter({blocks}, lambda x: length({text('x')}) >= 20 and length({bare}) >= length({text('x')}) * 0.5)"
    return f"nullif(array_to_string({stripped(f'list_transform({kept}, lambda x: {text("x")})')}, chr(10)), '')"


def tokens(text: str) -> str:
    return rf"regexp_extract_all({text}, '[\s]*[{_WORD}]+|[\s]*[^{_WORD}\s]|[\s]+$')"


_LINKS = r"""
links as (
  select page_id, url, unnest(range(len(m))) as pos, unnest(m) as tag
  from (select page_id, url, regexp_extract_all(html, '(?s)<a href="[^"]*">.*?</a>') as m from pages)
)"""


def set_page(url: str, n: str) -> str:
    parts = rf"list_filter(string_split(regexp_extract({url}, '\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]*=.'))"
    set_parts = f"list_transform({parts}, lambda p: case when split_part(p, '=', 1) = 'page' then 'page=' || {n} else p end)"
    full = f"case when len(list_filter({parts}, lambda p: split_part(p, '=', 1) = 'page')) > 0 then {set_parts} else list_append({parts}, 'page=' || {n}) end"
    return f"regexp_extract({url}, '^[^?#]*') || '?' || array_to_string({full}, '&') || regexp_extract({url}, '#.+$')"


def instant(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def ist(ts: str) -> str:
    local = f"({ts} + interval 330 minutes)"
    fraction = f"case when strftime({local}, '%f') = '000000' then '' else '.' || strftime({local}, '%f') end"
    return f"strftime({local}, '%Y-%m-%dT%H:%M:%S') || {fraction} || '+05:30'"


# --- text rules ------------------------------------------------------------------------------------------

_START, _END = rf"(?:^|[^{_WORD}])", rf"(?:$|[^{_WORD}])"


def company_at(title: str) -> str:
    pattern = rf"(?i){_START}at\s+([A-Za-z0-9 ]+)"
    return f"case when regexp_matches({title}, '{pattern}') then {strip(f'''regexp_extract({title}, '{pattern}', 1)''')} end"


def is_remote(title: str, text: str) -> str:
    return f"regexp_matches({title} || ' ' || {text}, '(?i){_START}remote{_END}')"


def role_simple(title: str) -> str:
    return f"case when regexp_matches(lower({title}), 'engineer|developer') then 'Engineering' else 'Other' end"


def role_family(title: str, text: str) -> str:
    rules = " ".join(f"when regexp_matches(lower({title} || ' ' || {text}), '{'|'.join(words)}') then '{name}'" for name, words in ROLE_RULES)
    return f"case {rules} else 'Other' end"


def company_from_title(title: str) -> str:
    patterns = (
        rf"(?i){_START}at\s+([A-Za-z0-9][A-Za-z0-9\s&.\-]+?)(?:\s*[-–|,(]|$)",
        r"(?i)^([A-Za-z0-9][A-Za-z0-9\s&.]+?)\s*(?:is\s+hiring|hiring|–|-)",
        r"(?i)\(([A-Za-z0-9][A-Za-z0-9\s&.]+)\)",
    )
    found = [strip(f"regexp_extract({title}, '{p}', 1)") for p in patterns]
    return "coalesce(" + ", ".join(f"case when length({f}) between 3 and 59 then {f} end" for f in found) + ")"


TITLED = """
titled as (
  select doc_id, text as description,
    case lang when 'fr' then 'Stage engineer at ' || source || ' Labs, Paris' when 'de' then source || ' GmbH is hiring'
      when 'es' then 'Remote designer (' || source || ' SA)' else '' end || '; ' || split_part(text, chr(10), 1) as title
  from documents
)"""

# --- feeds -----------------------------------------------------------------------------------------------

ITEMS = f"""
items as (
  select doc_id, lang, n_chars, text, lang = 'fr' as atom, doc_id // 50 as part,
    'http://feeds.example.com/' || case when lang = 'fr' then 'atom' else 'rss' end || (doc_id // 50) as source_url,
    case when lang = 'fr' then 'atom' else 'rss' end || (doc_id // 50) as source_name,
    row_number() over (partition by doc_id // 50, lang = 'fr' order by doc_id) - 1 as item_pos,
    {strip("split_part(text, chr(10), 1)")} as title,
    coalesce(url, '') as link,
    case lang when 'en' then strftime(stamp, '%a, %d %b %Y %H:%M:%S') || ' +0000'
      when 'de' then strftime(stamp, '%Y-%m-%dT%H:%M:%SZ') when 'fr' then (n_chars % 60) || ' hours ago' end as date_text,
    case lang when 'en' then stamp when 'de' then stamp when 'fr' then {AS_OF} - to_hours(n_chars % 60) else {AS_OF} end as published,
    case lang when 'en' then stamp when 'de' then stamp else {AS_OF} end as strict_published,
    {strip("text")} as description
  from (select d.*, timestamp '2024-01-01' + to_minutes(n_chars) as stamp, p.url from documents d left join pages p on d.doc_id = p.page_id)
)"""
PAPERS = f"""
papers as (
  select doc_id, {strip("replace(text, chr(10), ' ')")} as title, source || '|' || lang as authors,
    'http://papers.example.org/abs/' || doc_id as paper_url, timestamp '2024-01-01' + to_minutes(n_chars) as published,
    case when lang = 'en' then 'https://github.com/' || source || '/doc-' || doc_id end as github_url,
    text || case when lang = 'en' then ' Code: github.com/' || source || '/doc-' || doc_id || '.git' else '' end as abstract
  from documents
)"""
_ON_TOPIC = "(contains(lower(title), 'er the') or contains(lower(abstract), 'er the') or contains(lower(authors), 'er the'))"


def job_rows(items: str) -> str:
    return f"""
      select '1.0' as "schemaVersion", 'JOB' as "recordType", source_name, source_url, {company_at("title")} as content_company,
        {instant("published")} as content_date, {is_remote("title", "text")} as content_is_remote,
        {role_simple("title")} as content_role_family, {instant(AS_OF)} as "collectedAt"
      from {items} where published >= {AS_OF} - interval 24 hours"""


# --- catalog ---------------------------------------------------------------------------------------------

CATALOG = """
catalog as (
  select cast(split_part(p_brand, '#', 2) as integer) as store_pos, p_brand as store,
    'https://shop.example.com/products.json' as base_url, cast(p_partkey // 1000 + 1 as integer) as page_num,
    row_number() over (partition by p_brand, p_partkey // 1000 order by p_partkey) - 1 as item_pos, p_name as product_name,
    'https://shop.example.com/products/' || replace(p_name, ' ', '-') as product_url,
    case when p_type = 'PROMO' then 'General' else p_type end as category, lower(p_brand) as brand,
    case when p_size > 5 then '$' || cast(p_retailprice as varchar) end as price, 'USD' as currency,
    p_size > 5 and (p_size > 40 or p_size < 10) as available, repeat(p_name, 6) || ', ' || repeat(p_type, 6) as tags
  from part
)"""
FOOD = """
food as (
  select ascii(p_type) as category_pos, p_type as label, p_name as product_name,
    'https://world.openfoodfacts.org' || case when p_size > 3 then '/product/' || p_partkey else '' end as product_url,
    p_type as category, p_brand as brand, case when p_size > 10 then lower(p_type) else '' end as tags,
    p_size || ' g' as quantity, upper(left(p_type, 1)) as nutriscore, repeat(p_name, 10) as countries
  from part where length(p_name) >= 3
)"""
MARKET = """
market as (
  select p_type as category, 'https://market.example.com/' || p_type || '/' || (p_partkey // 50) as source_url, p_name as product_name,
    'https://market.example.com/p/' || p_partkey as product_url,
    case when p_size > 10 then '₹' || cast(p_retailprice as varchar) end as price,
    case when p_size > 30 then cast(p_size as varchar) end as rating
  from part where length(p_name) >= 5
)"""


def product_row(source_name: str, source_url: str, relation: str, **content: str) -> str:
    texts = ("category", "brand", "price", "currency", "tags", "product_url", "rating", "quantity", "nutriscore", "countries")
    columns = ", ".join(f"coalesce({content.get(t, 'null')}, '') as content_{t}" for t in texts)
    return f"""select 'ECOMMERCE_PRODUCT' as "recordType", {source_name} as source_name, {source_url} as source_url,
      product_name as "content_productName", {columns}, cast({content.get("available", "null")} as boolean) as content_available,
      '2024-01-03T05:30:00+05:30' as "collectedAt" from {relation}"""


# --- resolution ------------------------------------------------------------------------------------------


def form(name: str) -> str:
    return strip(f"lower(regexp_replace(replace(replace({name}, ',', ''), '.', ''), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'))")


def score(a: str, b: str) -> str:
    longest = f"greatest(length({a}), length({b}))"
    return f"(({longest} - levenshtein({a}, {b})) * 100) // {longest}"


def common_letters(a: str, b: str) -> str:
    """The length of the longest common subsequence: for each letter of one text a row of running maxima over the letters of the other."""
    codes = f"list_transform(string_split({b}, ''), lambda c: unicode(c)::integer)"
    letters = f"list_transform(string_split({a}, ''), lambda c: [unicode(c)::integer])"
    start = f"[list_resize([0::integer], (length({b}) + 1)::bigint, 0::integer)]"
    cell = f"greatest(row[k], case when k > 1 and {codes}[k - 1] = x[1] then row[k - 1] + 1 else 0 end)"
    step = f"list_transform(range(1, length({b}) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: {cell})))"
    return f"list_reduce(list_concat({start}, {letters}), lambda row, x: {step})[length({b}) + 1]"


def ratio(a: str, b: str) -> str:
    """The share of two texts, in percent, that insertions and deletions leave; 0 when one is empty."""
    total = f"(length({a}) + length({b}))"
    return f"case when {a} = '' or {b} = '' then 0.0::double else (1 - ({total} - 2 * {common_letters(a, b)}) / {total}::double) * 100 end"


PART_NAMES = """
names as (
  select p_partkey as pos, p_name || case when p_size > 40 then '' when p_size > 20 then ', s.' else ' ' || left(p_type, 1) end as name
  from part
)"""
PART_SEEDS = """
seeds as (select p_name as seed, min(p_partkey) as seed_pos from part where p_type = 'LARGE' and p_size > 45 group by p_name)"""


def lookup(threshold: int = 85, names: str = "names", seeds: str = "seeds", score=score, rounded=str) -> str:
    """Best seed per distinct name of a relation with ``name``."""
    return f"""
looked_up as (
  select name, case when {rounded("best.s")} >= {threshold} then best.seed else name end as canonical_name,
    cast(case when {rounded("best.s")} >= {threshold} then {rounded("best.s")} else 0 end as integer) as match_score
  from (
    select n.name, max(struct_pack(s := {score(form("n.name"), form("s.seed"))}, p := -s.seed_pos, seed := s.seed)) as best
    from (select distinct name from {names}) n left join {seeds} s on true group by n.name
  )
)"""


def loop(accepted) -> str:
    """The sequential loop: one step per open name in order of first appearance, the representatives so far as a list."""
    return f"""
open_names as (
  select name, {form("name")} as form, row_number() over (order by min(pos)) as i
  from names join looked_up using (name) where canonical_name = name group by name
), loop as (
  select cast(0 as bigint) as i, cast(null as varchar) as name, cast(null as varchar) as rep, cast([] as varchar[]) as reps
  union all
  select i, name, coalesce(hit, name), case when hit is null then list_append(reps, name) else reps end
  from (
    select o.i, o.name, l.reps, list_filter(l.reps, lambda r: {accepted("o.form", form("r"))})[1] as hit
    from loop l join open_names o on o.i = l.i + 1
  )
)"""


LOOP = loop(lambda a, b: f"{score(a, b)} >= 85")


def rounded(x: str) -> str:
    return f"round_even({x}, 0)"


RATIO_LOOKUP = lookup(score=ratio, rounded=rounded)
RATIO_LOOP = loop(lambda a, b: f"{rounded(ratio(a, b))} >= 85")


def directory(kind: str, content: str) -> str:
    """All cards of the listings that give a name, then the lookup."""
    return f"""with cards as (
      select c_custkey // 300 as listing, (c_custkey % 300) // 12 + 1 as page, c_name as name, c_acctbal as balance,
        c_acctbal > 1000 as extracted, c_acctbal > 1000 or c_mktsegment <> 'BUILDING' as accepted
      from customer
    ), names as (
      select * from cards where accepted
    ), seeds as (select c_custkey as seed_pos, c_name as seed from customer where c_acctbal > 9900),
    {lookup()}
    select '1.0' as "schemaVersion", '{kind}' as "recordType", case when extracted then 'Directory' else 'HeuristicFallback' end as source_name,
      'https://list.example.com/' || listing || '?page=' || page as source_url, {content}, {instant(AS_OF)} as "collectedAt"
    from names join looked_up using (name)"""


FLAT_ORDERS = """select o_orderkey as id, o_orderstatus as order_o_orderstatus, o_totalprice as order_detail_o_totalprice,
  o_orderpriority as order_detail_o_orderpriority, c_name as customer_name, c_mktsegment as customer_market_segment
  from orders join customer on o_custkey = c_custkey"""


#: Days of a user as pages, the quota of 25 left before each; a missing day ends the crawl.
EVENT_QUOTA = """cards as (
      select user_id, day(ts) as page, event_id, event_type <> 'error' as ok,
        row_number() over (partition by user_id, day(ts) order by event_id) as rank from events where day(ts) <= 20
    ), page_hits as (select user_id, page, coalesce(list(rank) filter (where ok), []) as hits from cards group by all),
    quotas as (
      select user_id, page, cast(25 as bigint) as quota from page_hits where page = 1
      union all
      select q.user_id, q.page + 1, q.quota - len(list_filter(h.hits, lambda r: r <= q.quota))
      from quotas q join page_hits h using (user_id, page) join page_hits n on n.user_id = q.user_id and n.page = q.page + 1
      where q.quota - len(list_filter(h.hits, lambda r: r <= q.quota)) > 0
    )"""


def oracles() -> dict[str, str]:
    chunks = f"""with cleaned as (select page_id, {tokens(clean_text("html"))} as toks from pages),
      windows as (
        select page_id, cast(i as integer) as chunk_no, list_slice(toks, i * 200 + 1, i * 200 + 200) as w
        from (select page_id, toks, unnest(range((len(toks) + 199) // 200)) as i from cleaned)
      )"""
    host, path = "regexp_extract(url, '^[a-z]+://[^/?#]*')", "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    folder = f"regexp_replace({path}, '[^/]*$', '')"
    junk = "|".join(JUNK_WORDS)
    year = "year(o_orderdate)"
    news_columns = f"""'1.0' as "schemaVersion", 'NEWS' as "recordType", source_name, source_url, title as content_title, link as content_url,
        {instant("published")} as content_published_date, description as content_summary,
        full_text as content_full_text, {instant(AS_OF)} as "collectedAt" """
    bodies = f"bodies as (select url as link, {main_text('html')} as full_text from pages)"
    return {
        "clean_html": f"select page_id, {clean_text('html')} as text from pages",
        "chunk_pages": f"{chunks} select page_id, chunk_no, cast(len(w) as integer) as n_tokens, array_to_string(w, '') as chunk_text from windows",
        "chunk_counts": f"{chunks} select page_id, count(*) as n_chunks, cast(sum(len(w)) as bigint) as n_tokens from windows group by page_id",
        "token_counts": f"select doc_id, cast(len({tokens('text')}) as bigint) as n_tokens from documents",
        "main_text": f"select page_id, {main_text('html')} as body from pages",
        "page_links": f"""with {_LINKS} select page_id, pos, {decode("regexp_extract(tag, 'href=" + '"([^"]*)"' + "', 1)")} as href,
            nullif({decode("regexp_extract(tag, '(?s)>(.*)</a>', 1)")}, '') as text from links""",
        "next_links": f"""select page_id, case when contains(url, '#top') then null when length(html) % 2 = 0
            then regexp_extract(url, '^[^?#]*') || '?p=2' else {host} || '/list/2' end as next_url from pages""",
        "page_frontier": f"select page_id, nullif({set_page('url', '2')}, url) as next_url from pages",
        "set_page": f"select page_id, {set_page('url', '(page_id + 3)')} as paged_url from pages",
        "resolve_links": f"""select page_id, href, case href when 'p/2' then {host} || {folder} || href when '?page=3' then {host} || {path} || href
            when '#frag' then regexp_extract(url, '^[^#]*') || href when '//cdn.example.com/x' then split_part(url, ':', 1) || ':' || href
            when 'https://o.com/y' then href when '../up' then {host} || regexp_replace({folder}, '[^/]+/$', '') || 'up'
            when '/abs/./x' then {host} || '/abs/x' else url end as resolved
            from pages, unnest(['p/2', '?page=3', '#frag', '//cdn.example.com/x', 'https://o.com/y', '../up', '/abs/./x', '']) as f(href)""",
        "product_links": f"""with {_LINKS} select page_id, pos,
            split_part('https://shop.example.com' || {decode("regexp_extract(tag, 'href=" + '"([^"]*)"' + "', 1)")}, '?', 1) as product_url,
            split_part(url, '?', 1) as page_product_url from links""",
        "path_ids": "select page_id, regexp_extract(rtrim(url, '/'), '[^/]*$') as path_id from pages",
        "list_item_cards": f"""select page_id, unnest(range(len(m))) as pos, {strip(decode("unnest(m)"))} as text
            from (select page_id, regexp_extract_all(html, '(?s)<li><a href="[^"]*">(.*?)</a></li>', 1) as m from pages)""",
        "heuristic_names": f"""select doc_id, list_filter(parts, lambda x: length(x) > 15 and not regexp_matches(lower(x), '{junk}'))[1] as name,
            list_filter(parts, lambda x: regexp_matches(x, '\\$|₹|€|Rs'))[1] as price
            from (select doc_id, {stripped("string_split(replace(text, chr(10), ' | '), '|')")} as parts from documents
                  where length(replace(text, chr(10), ' | ')) > 20)""",
        "junk_free_lines": f"""select doc_id, count(*) as n_lines, cast(sum(length(line)) as bigint) as n_chars
            from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)
            where length(line) > 15 and not regexp_matches(lower(line), '{junk}') group by doc_id""",
        "normalize_dates": f"""with w as (select event_id, user_id, ts, date_trunc('second', ts) as s from events)
            select event_id, form, {instant("read")} as read from (
              select event_id, 'mail' as form, s - interval 330 minutes as read from w
              union all select event_id, 'mail_named', s + interval 8 hours from w
              union all select event_id, 'mail_bare', s from w
              union all select event_id, 'iso', ts from w
              union all select event_id, 'hours', {EVENTS_AS_OF} - to_hours(event_id % 1000) from w
              union all select event_id, 'days', {EVENTS_AS_OF} - to_days(cast(user_id as integer)) from w
              union all select event_id, 'junk', {EVENTS_AS_OF} from w)""",
        "parse_dates": f"""select event_id, {ist("read")} as read_ist from (select event_id, case event_type when 'view' then {EVENTS_AS_OF}
            when 'click' then date_trunc('minute', ts) + interval 1 hour else date_trunc('second', ts) end as read from events)""",
        "ist_times": f"select event_id, {ist('ts')} as ts_ist from events",
        "fresh_events": f"select event_id, event_type, user_id from events where ts >= {EVENTS_AS_OF} - interval 24 hours",
        "job_rules": f"""with {TITLED} select doc_id, {company_at("title")} as company, {is_remote("title", "description")} as is_remote,
            {role_simple("title")} as role_simple, {role_family("title", "description")} as role_family from titled""",
        "company_from_titles": f"with {TITLED} select doc_id, {company_from_title('title')} as company from titled",
        "clean_names": rf"""select doc_id, line, {strip("replace(replace(name, ',', ''), '.', '')")} as name,
            {form(r"regexp_replace(name, '[\x{80}-\x{ff}]', '', 'g')")} as form
            from (select doc_id, cast(line - 1 as integer) as line, ' ' || lines[line] as name
              from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as line from (select doc_id, string_split(text, chr(10)) as lines from documents)))""",
        "flatten_orders": FLAT_ORDERS,
        "csv_round_trip": FLAT_ORDERS,
        "conform_orders": f"""select o_orderkey, '1.0' as "record_schemaVersion", 'STARTUP' as "record_recordType",
            'Order ' || o_orderkey as "record_content_entityName",
            cast(case when o_orderstatus = 'P' then null else {year} end as integer) as "record_content_data_foundedYear",
            cast(12 as integer) as "record_content_data_employeeCount", {instant("date_trunc('second', o_orderdate)")} as "record_collectedAt"
            from orders where left(o_orderpriority, 1) not in ('1', '2', '3', '4')""",
        "conform_rejects": """select o_orderkey, case left(o_orderpriority, 1) when '1' then 'content.data.employeeCount: invalid'
            when '2' then 'content.entityName: missing' when '3' then 'recordType: invalid' else 'not an object' end as errors
            from orders where left(o_orderpriority, 1) in ('1', '2', '3', '4')""",
        "stamped_records": f"""select '1.0' as "schemaVersion", 'STARTUP' as "recordType", 'Supplier list' as source_name, 'http://s/' || s_suppkey as source_url,
            s_name as "content_entityName", cast(null as integer) as "content_data_employeeCount", cast(null as integer) as "content_data_foundedYear",
            cast(null as varchar) as "content_data_fundingTotal", cast(null as varchar) as "content_data_fundingStage",
            cast(null as varchar) as content_data_description, {instant(AS_OF)} as "collectedAt" from supplier""",
        "first_event_per_user": """select user_id, event_id, event_type, value from events
            qualify row_number() over (partition by user_id order by ts, event_id) = 1""",
        "first_document_per_text": """select doc_id, source from documents where text <> ''
            qualify row_number() over (partition by text order by doc_id) = 1""",
        "first_by_priority": """select l_orderkey, l_partkey from lineitem qualify row_number() over (
            partition by l_orderkey order by case when l_returnflag = 'R' then 0 else 1 end, l_linenumber, l_partkey) = 1""",
        "newest_orders": "select o_orderkey, o_totalprice from orders order by o_orderdate desc, o_orderkey limit 1000",
        "main_text_regions": f"""with shown as (
              select page_id, replace(replace(html, '<article', case when page_id % 3 = 0 then '<main' else '<section' end), '</article',
                case when page_id % 3 = 0 then '</main' else '</section' end) || '<div><a href="/x">More of what others have read here</a> and some</div><p>The last block of this page.</p>' as html
              from pages) select page_id, {region_text("html")} as body from shown""",
        "page_quota": f"with recursive {EVENT_QUOTA} select user_id as start_url, event_id from cards join quotas using (user_id, page) where rank <= quota",
        "quota_progress": f"""with recursive {EVENT_QUOTA}, taken as (
              select user_id, page, ok from cards join quotas using (user_id, page) where rank <= quota)
            select u.user_id as start_url, cast(coalesce(max(page), 0) as integer) as pages_read, count(page) as offered, count(*) filter (where ok) as accepted,
              cast(25 as bigint) as cap, count(*) filter (where ok) >= 25 as is_full
            from (select distinct user_id from events) u left join taken t using (user_id) group by u.user_id""",
        "quota_progress_open": """with days as (
              select user_id, day(ts) as page, count(*) as n, count(*) filter (where event_type <> 'error') as ok from events group by all
            ), placed as (select *, row_number() over (partition by user_id order by page) as nth from days),
            taken as (select * from placed where page = nth)
            select u.user_id as start_url, cast(coalesce(max(page), 0) as integer) as pages_read, cast(coalesce(sum(n), 0) as bigint) as offered,
              cast(coalesce(sum(ok), 0) as bigint) as accepted, cast(null as bigint) as cap, false as is_full
            from (select distinct user_id from events) u left join taken t using (user_id) group by u.user_id""",
        "nearest_vectors": """with usable as (
              select vec_id, embedding::double[] as v from embeddings
              where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
            ), compared as (
              select q.vec_id, n.vec_id as neighbour_id, round(list_cosine_similarity(q.v, n.v), 9) as cosine
              from usable q join usable n on q.vec_id % 100 = 0 and n.vec_id <> q.vec_id
            ), ranked as (select *, cast(row_number() over (partition by vec_id order by cosine desc, neighbour_id) as integer) as rank from compared)
            select vec_id, rank, neighbour_id, round(cosine, 6) as cosine from ranked where rank <= 10""",
        "category_cap": """with counts as (select p_size, count(*) as n from part group by p_size),
            started as (select p_size, coalesce(sum(n) over (order by p_size rows between unbounded preceding and 1 preceding), 0) as before from counts)
            select p_size, p_partkey from part join started using (p_size) where before < 400""",
        "run_summary": """select source, cast(grouping(source) as integer) as is_total, count(*) as n_rows from documents group by rollup (source)""",
        "latest_events": "select event_id, event_type, value from events",
        "preview_pages": """select cast(page_id as varchar) as id, case when starts_with(url, 'http') then 'LINK' else url end as url,
            case when length(html) > 60 then left(html, 60) || '...' else html end as html from pages""",
        "ragged_regions": """select r_regionkey, r_name, cast(null as integer) as n_nationkey, '' as n_name, cast(null as integer) as n_regionkey,
              cast(null as bigint) as s_suppkey, '' as s_name from region
            union all select null, '', n_nationkey, n_name, n_regionkey, null, '' from nation
            union all select null, '', s_nationkey, '', null, s_suppkey, s_name from supplier""",
        "full_text_news": f"""with {bodies}, news as (
              select doc_id, case when lang = 'es' then '' else coalesce(url, 'http://gone/' || doc_id) end as link
              from documents left join pages on doc_id = page_id)
            select doc_id, link as url, full_text from news left join bodies using (link)""",
        "repo_stats": """select d.doc_id, case when lang <> 'es' then 'https://github.com/' || source || '/doc-' || d.doc_id || '.x' end as github_url,
            cast(case when lang <> 'es' then quality * 100 + toxic end as integer) as github_stars from documents d left join labels l on d.doc_id = l.doc_id""",
        "external_ids": """select o_orderkey, case when o_orderstatus <> 'F' then c_name end as external_ids
            from orders left join customer on o_custkey = c_custkey""",
        "first_valid_by_tier": """select conv_id as req_id, t.turn as tier, case when t.turn is not null then 'assistant' end as name, t.n as value
            from (select distinct conv_id from conversations) left join (
              select conv_id, min(turn) as turn, cast(arg_min(length(text), turn) as integer) as n from conversations
              where role = 'assistant' and length(text) >= 100 group by conv_id) t using (conv_id)""",
        "alive_tiers": "select distinct turn as tier from conversations where role = 'assistant'",
        "canonicalize_levenshtein": f"with {PART_NAMES}, {PART_SEEDS}, {lookup()} select pos, name, canonical_name, match_score from names join looked_up using (name)",
        "apply_mapping": f"""with {PART_NAMES}, {PART_SEEDS}, {lookup()}
            select canonical_name as name, count(*) as n_rows from names join looked_up using (name) group by canonical_name""",
        "dedup_levenshtein": f"""with recursive {PART_NAMES}, {PART_SEEDS}, {lookup()}, {LOOP}
            select l.name, coalesce(rep, canonical_name) as canonical_name from looked_up l left join loop using (name)""",
        "mapping_log_levenshtein": f"""with recursive {PART_NAMES}, {PART_SEEDS}, {lookup()}, {LOOP}
            select cast(0 as integer) as step, pos, name as raw_name, canonical_name, match_score from names join looked_up using (name)
            union all
            select cast(1 as integer), pos, n.name, rep, cast({score(form("n.name"), form("rep"))} as integer) from names n join loop using (name)
            where rep <> n.name or pos > (select min(pos) from names m where m.name = n.name)""",
        "stream_resolution": f"""with recursive {PART_NAMES}, {PART_SEEDS}, {lookup()}, {LOOP}
            select l.name, coalesce(rep, canonical_name) as canonical_name from looked_up l left join loop using (name)""",
        "canonicalize_ratio": f"with {PART_NAMES}, {PART_SEEDS}, {RATIO_LOOKUP} select pos, name, canonical_name, match_score from names join looked_up using (name)",
        "dedup_ratio": f"""with recursive {PART_NAMES}, {PART_SEEDS}, {RATIO_LOOKUP}, {RATIO_LOOP}
            select l.name, coalesce(rep, canonical_name) as canonical_name from looked_up l left join loop using (name)""",
        "mapping_log_ratio": f"""with recursive {PART_NAMES}, {PART_SEEDS}, {RATIO_LOOKUP}, {RATIO_LOOP}
            select cast(0 as integer) as step, pos, name as raw_name, canonical_name, match_score from names join looked_up using (name)
            union all
            select cast(1 as integer), pos, n.name, rep, cast({rounded(ratio(form("n.name"), form("rep")))} as integer) from names n join loop using (name)
            where rep <> n.name or pos > (select min(pos) from names m where m.name = n.name)""",
        "seed_file": f"""with {PART_NAMES}, {PART_SEEDS}, {lookup()} select pos, name, canonical_name, match_score from names join looked_up using (name)""",
        "link_records": f"""with recursive typed as (
              select 'PRODUCT' as entity_type, p_name || case when p_size > 40 then '' when p_size > 20 then ', s.' else ' ' || left(p_type, 1) end as name from part
              union all select 'STARTUP', s_name from supplier
              union all select 'LISTING', upper(p_name) || ' ' || left(p_type, 1) from part
            ), names as (select name, row_number() over (order by {form("name")}, name) as pos from (select distinct name from typed)),
            {PART_SEEDS}, {lookup()}, {LOOP}, found as (
              select l.name, match_score, canonical_name <> l.name as by_seed, coalesce(rep, canonical_name) as canonical from looked_up l left join loop using (name)
            ), named as (
              select *, case when canonical in (select seed from seeds) then null else sha1(unhex('{NAMESPACE.hex}') || encode({form("canonical")})) end as h from found
            )
            select entity_type, name as raw_name, case when h is null then 'seed_' || regexp_replace({form("canonical")}, ' +', '_', 'g')
                else h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', cast(('0x' || h[17]) as integer) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] end as canonical_id,
              canonical as canonical_name, cast(case when by_seed then match_score else {score(form("name"), form("canonical"))} end as integer) as match_score,
              count(*) as n_records, {instant(AS_OF)} as linked_at
            from typed join named using (name) group by all""",
        "mapping_file": f"""with {PART_NAMES}, {PART_SEEDS}, {lookup()} select name as "Raw_Name", canonical_name as "Canonical_Name",
            cast(match_score as bigint) as "Match_Score", count(*) as n_rows from names join looked_up using (name) group by all""",
        "feed_items": f"with {ITEMS} select source_url, item_pos, title, link, date_text, md5(text) as description_md5 from items",
        "feed_items_lenient": f"""with {ITEMS} select source_url, item_pos, title, case when link = '' and not atom then source_url else link end as link,
            date_text, md5(text) as description_md5 from items""",
        "paper_entries": f"""with {PAPERS} select title, authors, paper_url, {instant("published")} as published, github_url,
            length(abstract) as abstract_chars from papers""",
        "topic_papers": f"with {PAPERS} select paper_url from papers where {_ON_TOPIC}",
        "catalog_rows": f"with {CATALOG} select * from catalog",
        "food_rows": f"with {FOOD} select label, product_name, product_url, category, brand, tags from food",
        "nutrition_rows": f"with {FOOD} select label, product_name, product_url, category, brand, quantity, nutriscore, countries from food",
        "company_cards": """select s_name as name, n_name || ' ' || r_name as description, '/companies/' || lower(replace(s_name, '#', '-')) as href,
            cast(2 as bigint) as n_links from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
        "marketplace_cards": f"with {MARKET} select category, product_name, product_url, price, rating from market",
        "sourced_payloads": f"""with {ITEMS}, numbered as (select distinct source_url, cast(regexp_extract(source_url, '([0-9]+)$', 1) as integer) as n from items)
            select -n as src_pos, 'Feed ' || n as source_name, source_url from numbered where n % 3 <> 2""",
        "collection_round_trip": "select n_nationkey, n_name, cast(2 as bigint) as n_rows from nation",
        "collection_versions": "select n_nationkey, n_name, cast(2 as bigint) as n_rows from nation",
        "unseen_addresses": "select distinct url from pages where url not in (select url from pages where length(html) % 2 = 0 and url is not null) or url is null",
        "ragged_csv": """select r_name, null::varchar as n_name, null::bigint as n_nationkey, null::varchar as s_name, count(*) as n_rows from region group by r_name
            union all select null, n_name, n_nationkey, null, count(*) from nation group by all
            union all select null, null, s_nationkey, s_name, count(*) from supplier group by all""",
        "stream_xml_jobs": f"""with {ITEMS}, found as ({job_rows("items")})
            select content_company, content_date, content_is_remote, content_role_family, count(*) as n_items from found group by all""",
        "research_papers": f"""with {PAPERS} select '1.0' as "schemaVersion", 'RESEARCH_PAPER' as "recordType", 'ArXiv' as source_name, paper_url as source_url,
            title as content_title, authors as content_authors, paper_url as content_paper_url, github_url as content_github_url,
            cast(case when github_url is not null then quality * 100 + toxic end as integer) as content_github_stars,
            {instant("published")} as content_published_date, {instant(AS_OF)} as "collectedAt"
            from papers left join labels using (doc_id) where {_ON_TOPIC} """,
        "research_papers_with_ids": f"""with {PAPERS}, found as (select p.* replace (coalesce(github_url, case when lang in ('de', 'fr') then 'https://github.com/' || source || '/doc-' || doc_id end) as github_url) from papers p join documents using (doc_id)) select '1.0' as "schemaVersion", 'RESEARCH_PAPER' as "recordType", 'ArXiv' as source_name, paper_url as source_url,
            title as content_title, authors as content_authors, paper_url as content_paper_url, github_url as content_github_url,
            cast(case when github_url is not null then quality * 100 + toxic end as integer) as content_github_stars,
            {instant("published")} as content_published_date, {instant(AS_OF)} as "collectedAt"
            from found left join labels using (doc_id) where {_ON_TOPIC} """,
        "news": f"with {ITEMS}, {bodies} select {news_columns} from items left join bodies using (link) where published >= {AS_OF} - interval 24 hours",
        "jobs": f"with {ITEMS} {job_rows('items')}",
        "stream_jobs": f"with {ITEMS} {job_rows('items')}",
        "stream_dedupe": f"""with {ITEMS}, kept as (
              select * from items union all select * from items where link = ''), found as ({job_rows("kept")})
            select source_url, content_company, content_date, content_is_remote, content_role_family, count(*) as n_items from found group by all""",
        "job_listings": f"""with {ITEMS}, rows as (
              select *, case when link = '' and not atom then source_url else link end as job_url, description as snippet from items)
            select 'JOB' as "recordType", source_name, source_url, title as content_title, {company_from_title("title")} as content_company,
              job_url as content_job_url, {ist("strict_published")} as content_date, {is_remote("title", "snippet")} as content_is_remote,
              {role_family("title", "snippet")} as content_role_family, snippet as content_description_snippet,
              '2024-01-03T05:30:00+05:30' as "collectedAt"
            from rows qualify row_number() over (partition by job_url order by part * 2 + cast(atom as integer), item_pos) = 1""",
        "catalog_products": f"""with {CATALOG}, {FOOD}, {MARKET},
            first as (select * from catalog qualify row_number() over (partition by product_url order by store_pos, page_num, item_pos) = 1),
            counts as (select category_pos, count(*) as n from food group by category_pos),
            started as (select category_pos, coalesce(sum(n) over (order by category_pos rows between unbounded preceding and 1 preceding), 0) as before from counts),
            capped as (select * from food)
            {product_row("store", "product_url", "first", category="category", brand="brand", price="price", currency="currency", available="available", tags="tags", product_url="product_url")}
            union all {product_row("'Open Food Facts'", "product_url", "capped", category="category", brand="brand", available="true", tags="tags", product_url="product_url")}
            union all {product_row("'Market'", "source_url", "market", category="category", price="price", rating="rating", product_url="product_url")}
            union all {product_row("'Open Food Facts'", "'https://food.example.com/' || label", "food", category="category", brand="brand", quantity="quantity", nutriscore="nutriscore", countries="countries", product_url="product_url")}""",
        "company_list": f"""with names as (select s_name as name, s_suppkey, s_nationkey from supplier),
            seeds as (select s_suppkey as seed_pos, s_name as seed from supplier where s_acctbal > 9000), {lookup(90)}
            select '1.0' as "schemaVersion", 'STARTUP' as "recordType", 'Directory' as source_name,
              'https://dir.example.com/companies/' || lower(replace(name, '#', '-')) as source_url, canonical_name as "content_entityName",
              n_name || ' ' || r_name as content_data_description, cast(null as varchar) as content_data_batch,
              cast(null as integer) as "content_data_foundedYear", 'YC' as "content_data_fundingStage", '2024-01-03T05:30:00+05:30' as "collectedAt"
            from names join looked_up using (name) join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
        "startups": directory(
            "STARTUP",
            """canonical_name as "content_entityName", cast(null as integer) as "content_data_employeeCount",
            cast(case when extracted then 2001 end as integer) as "content_data_foundedYear", cast(null as varchar) as "content_data_fundingTotal",
            case when extracted then 'seed' end as "content_data_fundingStage", cast(null as varchar) as content_data_description""",
        ),
        "products": directory(
            "PRODUCT",
            """canonical_name as "content_startupName", case when extracted then 'PAID' else 'UNKNOWN' end as "content_pricingModel" """,
        ),
        "ecommerce_products": directory(
            "ECOMMERCE_PRODUCT",
            """canonical_name as "content_productName", case when not extracted then '$' || cast(balance as varchar) end as content_price,
            case when extracted then 'b' end as content_brand, cast(null as varchar) as content_rating""",
        ),
    }
