"""The queries as SQL over the test tables."""

from __future__ import annotations

from moodline.functions.measures import CLASS_LABELS
from moodline.functions.text import WHITESPACE_CHARS, WORD_CHARS
from workload.tables import ASPECT_VALENCES, CANDIDATES, ENTITIES, PHRASES, SHIFTING, VALENCES

A, B = ENTITIES


# Whitespace as members of a character class, for a dialect without Unicode classes.
BLANK = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
CLEANING = (
    rf"(http|www)[^{BLANK}]+",
    rf"@[{WORD_CHARS}]+|#",
    rf"[^a-zA-Z0-9{BLANK}]",
)


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _mention(text: str, word: str) -> str:
    pattern = f"(^|[^{WORD_CHARS}]){word}($|[^{WORD_CHARS}])"
    return f"cast(coalesce(regexp_matches(lower({text}), '{pattern}'), false) as bigint)"


def _contains(text: str) -> str:
    return " or ".join(f"contains(lower({text}), '{e}')" for e in ENTITIES)


def _clean(text: str) -> str:
    for pattern in CLEANING:
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    blanks = " || ".join(f"chr({ord(c)})" for c in WHITESPACE_CHARS)
    return f"trim(lower({text}), {blanks})"


def _r(expression: str) -> str:
    return f"round({expression} + 1e-10, 6)"


def _indicator(label: str) -> str:
    return (
        f"case lower({label}) when 'positive' then 1 when 'neutral' then 0 "
        "when 'negative' then -1 end"
    )


def _label(score: str) -> str:
    return (
        f"case when {score} >= 0.05 then 'positive' when {score} <= -0.05 then 'negative' "
        "else 'neutral' end"
    )


# --- input tables ---------------------------------------------------------------------

POSTS = """posts as (
  select d.doc_id as tweet_id, d.text as tweet, d.lang = 'en' as is_en, d.source as country,
         e.ts as created_at, cast(floor(e.value) as double) as likes,
         cast((e.user_id * 37) % 1000 as double) as user_followers_count,
         u.joined as user_join_date
  from documents d
  join events e on e.event_id = d.doc_id * 5
  join (select user_id, min(ts) as joined from events group by user_id) u
    on u.user_id = e.user_id)"""

ARTICLES = f"""{POSTS},
articles as (
  select tweet_id as article_id, split_part(tweet, chr(10), 1) as title,
         substr(tweet, length(split_part(tweet, chr(10), 1)) + 2) as description,
         case when is_en then 'en' else 'other' end as language, created_at as published_at
  from posts)"""

COMPOSED = f"""{ARTICLES},
composed as (
  select article_id, title, published_at,
         case when {_contains("description")} then title || ' . ' || description
              else title end as composed
  from articles)"""

NEWS = f"""{COMPOSED},
news as (
  select article_id, lower(composed) as textdata, epoch_us(published_at) as timestamp,
         {_mention("composed", A)} as mentions_{A}, {_mention("composed", B)} as mentions_{B}
  from composed)"""

LEXICON = "lexicon(token, valence) as (values " + ", ".join(
    f"('{w}', cast({v} as double))" for w, v in VALENCES.items()
) + ")"

TOKENS = f"""split as (
  select doc_id, string_split_regex(lower(text), '[^{WORD_CHARS}'']+') as words
  from documents),
tokens as (
  select doc_id, unnest(words) as raw, generate_subscripts(words, 1) as pos from split)"""

SUMS = f"""{LEXICON},
{TOKENS},
sums as (
  select doc_id, sum(valence) as total, count(*) as matched
  from tokens join lexicon on token = trim(raw, '''') group by doc_id)"""

# The same with valences for the entities too.
PROMPT_SUMS = SUMS.replace(
    LEXICON, LEXICON[:-1] + "".join(f", ('{w}', cast({v} as double))" for w, v in ASPECT_VALENCES.items()) + ")"
)

COMPOUND = "round(total / sqrt(total * total + 15), 4)"

FLAGGED = f"""flagged as materialized (
  select doc_id, {_mention("text", A)} as mentions_{A}, {_mention("text", B)} as mentions_{B}
  from documents)"""


def _gated(word: str) -> str:
    return f"case when mentions_{word} = 1 then coalesce({COMPOUND}, 0) else 0 end"


SCORED = f"""{SUMS},
{FLAGGED},
gated as (
  select f.doc_id, mentions_{A}, mentions_{B},
         {_gated(A)} as {A}_score, {_gated(B)} as {B}_score
  from flagged f left join sums s on s.doc_id = f.doc_id),
scored as (
  select *, {_label(f"{A}_score")} as {A}_label, {_label(f"{B}_score")} as {B}_label
  from gated)"""

SCORED_POSTS = f"""{SCORED},
{POSTS},
scored_posts as (
  select s.*, cast(p.created_at as date) as date, p.created_at, p.is_en, p.likes,
         p.user_followers_count, p.user_join_date
  from scored s join posts p on p.tweet_id = s.doc_id)"""

SIGNALS = """signals as (
  select cast(ts as date) as date, event_type as candidate,
         case when value >= 60 then 'Positive' when value <= 20 then 'Negative'
              else 'Neutral' end as sentiment_label
  from events where event_type in ('click', 'view'))"""

RATIOS = f"""{SIGNALS},
ratios as (
  select date, candidate, sum({_indicator("sentiment_label")}) as total, count(*) as n,
         sum({_indicator("sentiment_label")}) / cast(count(*) as double) as ratio
  from signals group by date, candidate)"""

LABELS = """labels_daily as (
  select cast(ts as date) as date,
         avg(case when value > 34 then cast(1 as double) else cast(0 as double) end) as p_win
  from events group by 1)"""

C, V = CANDIDATES
FEATURES = f"""{RATIOS},
{LABELS},
wide as (
  select date, max(ratio) filter (where candidate = '{C}') as {C},
         max(ratio) filter (where candidate = '{V}') as {V}
  from ratios group by date),
features as (
  select wide.date, {C}, {V}, p_win from wide join labels_daily on labels_daily.date = wide.date)"""

OLS = f"""{FEATURES},
filled as (
  select date, coalesce({C}, 0) as x1, coalesce({V}, 0) as x2, coalesce(p_win, 0) as y
  from features),
moments as (
  select sum(x1 * x1) as s11, sum(x1 * x2) as s12, sum(x2 * x2) as s22,
         sum(x1 * y) as s1y, sum(x2 * y) as s2y, sum(y * y) as syy
  from filled),
betas as (
  select (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1,
         (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2, s1y, s2y, syy
  from moments),
fitted as (
  select date, y, b1 * x1 + b2 * x2 as p from filled, betas)"""

SERIES = """prices as (
  select cast(o_orderdate as date) as date, avg(o_totalprice) / 500000 as y
  from orders group by 1),
discounts as (
  select cast(l_shipdate as date) as date, avg(l_discount) * 10 as x from lineitem group by 1),
series as (select x, y from prices join discounts on discounts.date = prices.date),
m as (
  select count(*) as n, avg(x) as mx, avg(y) as my, regr_sxx(y, x) as sxx, regr_sxy(y, x) as sxy,
         regr_syy(y, x) as syy
  from series)"""


SALES = """sales as (
  select avg(l_extendedprice) / 100000 as x1, avg(l_tax) * 10 as x2,
         avg(l_extendedprice * (1 - l_discount)) / 100000 as y
  from lineitem group by cast(l_shipdate as date)),
m as (
  select count(*) as n, avg(x1) as m1, avg(x2) as m2, avg(y) as my, regr_sxx(y, x1) as s11,
         regr_sxx(y, x2) as s22, regr_sxy(x1, x2) as s12, regr_sxy(y, x1) as s1y, regr_sxy(y, x2) as s2y,
         regr_syy(y, x1) as syy
  from sales)"""


SALES_ROLLED = SALES.replace("sales as (", """daily as (
  select cast(l_shipdate as date) as date,""", 1).replace("""
  select avg(""", " avg(", 1).replace("group by cast(l_shipdate as date)),", """group by 1),
sales as (
  select x1, x2, avg(y) over (order by date rows between 6 preceding and current row) as y from daily),""", 1)


def _two_features(b1: str, b2: str) -> str:
    """Coefficients and R² of a plane with given slopes through the means."""
    r2 = "(2 * (b1 * s1y + b2 * s2y) - b1 * b1 * s11 - 2 * b1 * b2 * s12 - b2 * b2 * s22) / syy"
    return f"""with {SALES}, slopes as (select *, {b1} as b1, {b2} as b2 from m)
select 'price' as feature, {_r("b1")} as beta, {_r(r2)} as r2 from slopes
union all select 'tax', {_r("b2")}, {_r(r2)} from slopes
union all select 'intercept', {_r("my - b1 * m1 - b2 * m2")}, {_r(r2)} from slopes"""


def _ridge_slopes(alpha: float) -> tuple[str, str]:
    det = f"((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12)"
    return f"(s1y * (s22 + {alpha}) - s2y * s12) / {det}", f"(s2y * (s11 + {alpha}) - s1y * s12) / {det}"


LASSO_KEEPS = "sign(s1y) * greatest(abs(s1y) - 0.0002 * n, 0) / s11"
#: the second slope is 0 where its gradient at 0 is within the penalty; null would be no match
LASSO_DROPS = f"case when abs(s2y - {LASSO_KEEPS} * s12) <= 0.0002 * n then cast(0 as double) end"


def _one_feature(slope: str) -> str:
    """Coefficients and R² of a line with a given slope through the means."""
    r2 = "(2 * b * sxy - b * b * sxx) / syy"
    return f"""with {SERIES}, slope as (select *, {slope} as b from m)
select 'discount' as feature, {_r("b")} as beta, {_r(r2)} as r2 from slope
union all select 'intercept', {_r("my - b * mx")}, {_r(r2)} from slope"""


PATH = f"""{SALES},
marks as (
  select 'p_win' as label, m.* from m
  union all
  select 'p_lose', n, m1, m2, 1 - my, s11, s22, s12, -s1y, -s2y, syy from m),
ridge as (
  select *, 'Ridge' as model, alpha,
    (s1y * (s22 + alpha) - s2y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as b1,
    (s2y * (s11 + alpha) - s1y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as b2
  from marks, (values (0.0::double), (0.5::double), (2.0::double), (8.0::double)) a(alpha)),
-- a lasso of two features: the best of what is stationary with both, one or none of them
tried as (
  select *, alpha * n as pen
  from marks, (values (0.0::double), (0.0001::double), (0.0002::double), (0.001::double), (0.01::double)) a(alpha)),
stationary as (
  select *, ((s1y - pen * g1) * s22 - (s2y - pen * g2) * s12) / (s11 * s22 - s12 * s12) as b1,
    ((s2y - pen * g2) * s11 - (s1y - pen * g1) * s12) / (s11 * s22 - s12 * s12) as b2
  from tried, (values (1, 1), (1, -1), (-1, 1), (-1, -1)) g(g1, g2)
  union all select *, 0, 0, sign(s1y) * greatest(abs(s1y) - pen, 0) / s11, 0 from tried
  union all select *, 0, 0, 0, sign(s2y) * greatest(abs(s2y) - pen, 0) / s22 from tried),
lasso as (
  select label, alpha, arg_min(b1, cost) as b1, arg_min(b2, cost) as b2 from (
    select *, b1 * b1 * s11 / 2 + b1 * b2 * s12 + b2 * b2 * s22 / 2 - b1 * s1y - b2 * s2y
      + pen * (abs(b1) + abs(b2)) as cost
    from stationary where g1 = 0 or (b1 * g1 >= 0 and b2 * g2 >= 0))
  group by label, alpha),
fits as (
  select label, model, alpha, b1, b2 from ridge
  union all select label, 'Lasso', alpha, b1, b2 from lasso),
path as (
  select f.*, my - b1 * m1 - b2 * m2 as b0,
    (2 * (b1 * s1y + b2 * s2y) - b1 * b1 * s11 - 2 * b1 * b2 * s12 - b2 * b2 * s22) / syy as r2
  from fits f join marks on marks.label = f.label)"""


GRID_INDICATOR = {e: _indicator(f"({_label(f'{e}_score')})") for e in ENTITIES}
GRID = f"""{SUMS},
{FLAGGED},
{POSTS},
{LABELS},
gated as (
  select sentiment, f.doc_id, mentions_{A}, mentions_{B}, {", ".join(
    f"case when mentions_{e} = 1 then coalesce(case sentiment when 'VADER' then {COMPOUND} "
    f"else total / matched end, 0) else 0 end as {e}_score" for e in ENTITIES)}
  from (values ('VADER'), ('TextBlob')) v(sentiment), flagged f left join sums s on s.doc_id = f.doc_id),
marked as (
  select sentiment, cast(created_at as date) as date, is_en, mentions_{A} = 1 as about_a,
    mentions_{B} = 1 as about_b, {GRID_INDICATOR[A]} as a, {GRID_INDICATOR[B]} as b
  from gated join posts on posts.tweet_id = gated.doc_id),
shapes as (
  select 'train' as split, sentiment, '2RATIOS' as features, date, avg(a) filter (where about_a) as x1,
    avg(b) filter (where about_b) as x2 from marked where is_en and (about_a or about_b) group by all
  union all
  select 'train', sentiment, '1RATIO', date, avg(a), cast(0 as double) from marked
  where is_en and about_a group by all
  union all
  select 'test', sentiment, '2RATIOS', date, avg(a), avg(b) from marked group by all
  union all
  select 'test', sentiment, '1RATIO', date, avg(a), cast(0 as double) from marked where about_a group by all),
shaped as (select shapes.*, p_win as y from shapes join labels_daily on labels_daily.date = shapes.date),
m as (
  select split, sentiment, features, count(*) as n, avg(x1) as m1, avg(x2) as m2, avg(y) as my,
    regr_sxx(y, x1) as s11, regr_sxx(y, x2) as s22, regr_sxy(x1, x2) as s12, regr_sxy(y, x1) as s1y,
    regr_sxy(y, x2) as s2y, sum(x1 * x1) as o11, sum(x1 * x2) as o12, sum(x2 * x2) as o22,
    sum(x1 * y) as o1y, sum(x2 * y) as o2y
  from shaped group by all),
sided as (
  select *, split = 'test' as raw,
    case when split = 'test' then o11 else s11 end as u11, case when split = 'test' then o12 else s12 end as u12,
    case when split = 'test' then o22 else s22 end as u22, case when split = 'test' then o1y else s1y end as u1y,
    case when split = 'test' then o2y else s2y end as u2y from m),
tried as (select *, 0.01 * n as pen from m),
stationary as (
  select *, ((s1y - pen * g1) * s22 - (s2y - pen * g2) * s12) / (s11 * s22 - s12 * s12) as b1,
    ((s2y - pen * g2) * s11 - (s1y - pen * g1) * s12) / (s11 * s22 - s12 * s12) as b2
  from tried, (values (1, 1), (1, -1), (-1, 1), (-1, -1)) g(g1, g2) where features = '2RATIOS'
  union all select *, 0, 0, sign(s1y) * greatest(abs(s1y) - pen, 0) / s11, 0 from tried
  union all select *, 0, 0, 0, sign(s2y) * greatest(abs(s2y) - pen, 0) / s22 from tried
    where features = '2RATIOS'),
lasso as (
  select split, sentiment, features, arg_min(b1, cost) as b1, arg_min(b2, cost) as b2 from (
    select *, b1 * b1 * s11 / 2 + b1 * b2 * s12 + b2 * b2 * s22 / 2 - b1 * s1y - b2 * s2y
      + pen * (abs(b1) + abs(b2)) as cost
    from stationary where g1 = 0 or (b1 * g1 >= 0 and b2 * g2 >= 0))
  group by all),
slopes as (
  select split, sentiment, features, 'OLS' as model, '' as options, raw,
    case when features = '1RATIO' then u1y / u11 else (u1y * u22 - u2y * u12) / (u11 * u22 - u12 * u12) end as b1,
    case when features = '1RATIO' then 0 else (u2y * u11 - u1y * u12) / (u11 * u22 - u12 * u12) end as b2 from sided
  union all
  select split, sentiment, features, 'Ridge', 'alpha=0.1', false,
    (s1y * (s22 + 0.1) - s2y * s12) / ((s11 + 0.1) * (s22 + 0.1) - s12 * s12),
    (s2y * (s11 + 0.1) - s1y * s12) / ((s11 + 0.1) * (s22 + 0.1) - s12 * s12) from m
  union all
  select split, sentiment, features, 'Lasso', 'alpha=0.01', false, b1, b2 from lasso),
guessed as (
  select s.split, s.sentiment, s.features, model, options, y,
    case when raw then 0 else my - b1 * m1 - b2 * m2 end + b1 * x1 + b2 * x2 as p
  from slopes s
  join m on m.split = s.split and m.sentiment = s.sentiment and m.features = s.features
  join shaped on shaped.split = s.split and shaped.sentiment = s.sentiment and shaped.features = s.features)"""


def _less(target: str, by: str) -> str:
    """A column without its component along another one."""
    return f"{target} - {by} * sum({target} * {by}) over () / sum({by} * {by}) over ()"


def _partial_out(name: str, columns: int, steps: int) -> str:
    """CTEs name1.. that take c0, then the next one and so on, out of y and the rest of name0."""
    ctes = []
    for step in range(steps):
        rest = [f"{_less(f'c{i + 1}', 'c0')} as c{i}" for i in range(columns - step - 1)]
        kept = ", ".join(["t", f"{_less('y', 'c0')} as y", *rest])
        ctes.append(f"{name}{step + 1} as materialized (select {kept} from {name}{step})")
    return ", ".join(ctes)


def _last_beta(name: str, source: str, label: str, columns: list[str]) -> str:
    """CTEs that end in name(beta): the coefficient of the last column in a regression on all."""
    first = ", ".join(f"{c} as c{i}" for i, c in enumerate(columns))
    steps = len(columns) - 1
    return (
        f"{name}0 as (select t, {label} as y, {first} from {source}), "
        f"{_partial_out(name, len(columns), steps)}, "
        f"{name} as (select sum(y * c0) / sum(c0 * c0) as beta from {name}{steps})"
    )


ARIMAX = f"""dated as (
  select prices.date as t, x, y from prices join discounts on discounts.date = prices.date),
diffs as (
  select t, y - lag(y) over (order by t) as dy, x - lag(x) over (order by t) as dx from dated),
lags as (
  select t, dy, dx, lag(dy, 1) over w as l1, lag(dy, 2) over w as l2, lag(dy, 3) over w as l3,
         lag(dy, 4) over w as l4 from diffs window w as (order by t)),
long0 as materialized (
  select t, dy as y, dx as c0, l1 as c1, l2 as c2, l3 as c3, l4 as c4 from lags
  where l4 is not null and dx is not null),
{_partial_out("long", 5, 5)},
shocks as (select t, lag(y) over (order by t) as s1 from long5),
short as materialized (
  select lags.t, dy, dx, l1, s1 from shocks join lags on lags.t = shocks.t where s1 is not null),
{_last_beta("b_x", "short", "dy", ["l1", "s1", "dx"])},
{_last_beta("b_ar", "short", "dy", ["dx", "s1", "l1"])},
{_last_beta("b_ma", "short", "dy", ["dx", "l1", "s1"])}"""

GRAMS = r"""spaced as (
  select doc_id, lang,
         string_split(' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ', '') as c
  from documents),
grams as materialized (
  select doc_id, lang, unnest(list_transform(range(1, len(c) - 1),
         lambda i: c[i] || c[i + 1] || c[i + 2])) as gram
  from spaced),
counts as materialized (select lang, gram, count(*) as n from grams group by lang, gram),
totals as (
  select lang, ln(sum(n) + (select count(distinct gram) from counts)) as log_total
  from counts group by lang)"""

IS_EN = f"""{GRAMS},
pieces as (select doc_id, gram, count(*) as k from grams group by doc_id, gram),
sizes as (select doc_id, sum(k) as k from pieces group by doc_id),
hits as (
  select doc_id, counts.lang, sum(k * ln(n + 1)) as hit
  from pieces join counts on counts.gram = pieces.gram group by doc_id, counts.lang),
ranked as (
  select s.doc_id, t.lang,
         row_number() over (partition by s.doc_id
           order by coalesce(hit, 0) - s.k * log_total desc, t.lang) as place
  from sizes s cross join totals t
  left join hits on hits.doc_id = s.doc_id and hits.lang = t.lang),
best as (select doc_id, lang from ranked where place = 1),
english as (select doc_id from best where lang = 'en')"""

MERGED = f"""{POSTS},
marked as (
  select *, {_mention("tweet", A)} as mentions_{A}, {_mention("tweet", B)} as mentions_{B}
  from posts),
sources as (
  select *, 0 as source_rank from marked where mentions_{A} = 1
  union all select *, 1 from marked where mentions_{B} = 1),
tagged as (
  select * exclude (mentions_{A}, mentions_{B}),
         case source_rank when 0 then 1 else 0 end as mentions_{A},
         case source_rank when 1 then 1 else 0 end as mentions_{B} from sources),
flags as (
  select tweet_id, max(mentions_{A}) as fa, max(mentions_{B}) as fb
  from tagged group by tweet_id),
firsts as (
  select *, row_number() over (partition by tweet_id order by source_rank) as place from tagged),
merged as (
  select firsts.*, fa, fb from firsts join flags on flags.tweet_id = firsts.tweet_id
  where place = 1)"""

AGE = "cast(floor((epoch_us(created_at) - epoch_us(user_join_date)) / 86400000000.0) as bigint)"

WEIGHTS = {1: 0.293, 2: 0.293 * 0.95, 3: 0.293 * 0.9}


def _boost(step: int) -> str:
    word = f"trim(lag(raw, {step}) over w, '''')"
    return (
        f"case when {word} in ({_list(SHIFTING['intensifiers'])}) then {WEIGHTS[step]!r} "
        f"when {word} in ({_list(SHIFTING['dampeners'])}) then -{WEIGHTS[step]!r} else 0 end"
    )


def _flip(step: int) -> str:
    word = f"trim(lag(raw, {step}) over w, '''')"
    return f"case when {word} in ({_list(SHIFTING['negations'])}) then -0.74 else 1 end"


SHIFT = f"""{TOKENS},
turns as (select doc_id, min(pos) as turn from tokens
  where raw = '{SHIFTING["contrast"]}' group by doc_id),
marks as (
  select doc_id, length(text) - length(replace(text, '!', '')) as loud,
         length(text) - length(replace(text, '?', '')) as asked from documents),
emphasis as (
  select doc_id, least(loud, 4) * cast(0.292 as double)
    + case when asked > 3 then cast(0.96 as double)
           when asked > 1 then asked * cast(0.18 as double) else 0 end as added from marks),
context as (
  select doc_id, pos, trim(raw, '''') as token,
         cast({" + ".join(_boost(k) for k in (1, 2, 3))} as double) as boost,
         cast({" * ".join(_flip(k) for k in (1, 2, 3))} as double) as flip
  from tokens window w as (partition by doc_id order by pos))"""
SHIFTED = f"""{LEXICON},
{SHIFT},
plain as (
  select c.doc_id, sum((valence + sign(valence) * boost) * flip
         * case when pos < turn then cast(0.5 as double) when pos > turn then cast(1.5 as double)
           else cast(1 as double) end) as total
  from context c join lexicon l on l.token = c.token
  left join turns on turns.doc_id = c.doc_id group by c.doc_id),
sums as (
  select plain.doc_id, total + sign(total) * added as total
  from plain join emphasis on emphasis.doc_id = plain.doc_id)"""


# Entries of several words: all that occur, then for each text from left to right the longest at a
# place, unless an earlier one reaches into it.
_LONGEST = max(len(p.split()) for p in PHRASES)
ENTRIES = "entries(entry, size, valence) as (values " + ", ".join(
    f"('{p}', {len(p.split())}, cast({v} as double))" for p, v in (VALENCES | PHRASES).items()
) + ")"
OCCURRING = f"""{ENTRIES},
grams as (
  select doc_id, pos, n, {" || ".join(
      ["token"] + [f"case when n > {k} then ' ' || lead(token, {k}) over w else '' end" for k in range(1, _LONGEST)]
  )} as gram
  from context, range(1, {_LONGEST + 1}) r(n) window w as (partition by doc_id, n order by pos)),
occurring as (
  select g.doc_id, g.pos, g.n, e.valence from grams g join entries e on e.entry = g.gram and e.size = g.n),
longest as (
  select doc_id, pos, max(n) as n, arg_max(valence, n) as valence from occurring group by doc_id, pos)"""


def _apart(value: str, joins: str = "") -> str:
    """CTE ``sums``: total and number of the entries that stay."""
    return f"""listed as (
  select m.doc_id, list({{'pos': m.pos, 'free': m.pos + m.n, 'total': {value}, 'n': 1}} order by m.pos) as found
  from longest m {joins} group by m.doc_id),
reduced as (
  select doc_id, list_reduce(found, lambda a, x: case when x.pos >= a.free
    then {{'pos': x.pos, 'free': x.free, 'total': a.total + x.total, 'n': a.n + 1}} else a end) as r
  from listed)"""


PHRASES_SHIFTED = f"""{SHIFT},
{OCCURRING},
{_apart(
    "(m.valence + sign(m.valence) * c.boost) * c.flip * case when m.pos < turn then cast(0.5 as double) "
    "when m.pos > turn then cast(1.5 as double) else cast(1 as double) end",
    "join context c on c.doc_id = m.doc_id and c.pos = m.pos left join turns on turns.doc_id = m.doc_id",
)},
sums as (
  select r.doc_id, r.r.total + sign(r.r.total) * added as total
  from reduced r join emphasis on emphasis.doc_id = r.doc_id)"""

PHRASED = f"""{TOKENS},
context as (select doc_id, pos, trim(raw, '''') as token from tokens),
{OCCURRING},
{_apart("m.valence")},
sums as (select doc_id, r.total as total, r.n as matched from reduced)"""


def _thirds(n: int) -> str:
    start = {0: "1", 1: "k + 1", 2: "2 * k + 1"}[n]
    stop = {0: "k", 1: "2 * k", 2: "len(embedding)"}[n]
    return f"list_sum(list_transform(embedding[{start}:{stop}], lambda x: cast(x as double)))"


SOFTMAX = f"""cut as (select vec_id, embedding, len(embedding) // 3 as k from embeddings),
logits as (
  select vec_id, {_thirds(0)} as l0, {_thirds(1)} as l1, {_thirds(2)} as l2 from cut),
powers as (
  select vec_id, exp(l0 - greatest(l0, l1, l2)) as e0, exp(l1 - greatest(l0, l1, l2)) as e1,
         exp(l2 - greatest(l0, l1, l2)) as e2 from logits)"""

NEG, NEU, POS = CLASS_LABELS
BAND = 0.05  # means within it are neutral

ENHANCED = f"""{SCORED_POSTS},
{LABELS},
long as (
  select date, '{A}' as candidate, {A}_label as label, is_en, likes, user_followers_count,
         created_at, user_join_date from scored_posts where mentions_{A} = 1
  union all
  select date, '{B}', {B}_label, is_en, likes, user_followers_count, created_at, user_join_date
  from scored_posts where mentions_{B} = 1),
kept as (
  select date, candidate, avg({_indicator("label")}) as mean from long
  where {AGE} > 0 and user_followers_count > 5 and likes > 5 and is_en
  group by date, candidate),
rolled as (
  select *, avg(mean) over (order by date, candidate rows between 6 preceding and current row)
    as rolling, mean / (abs(mean) + 1) as ratio
  from kept),
wide as (
  select date, {", ".join(
    f"max({column}) filter (where candidate = '{e}') as {name.format(e)}"
    for column, name in (("ratio", '"{}"'), ("mean", "{}_mean"), ("rolling", "{}_rolling"))
    for e in ENTITIES)}
  from rolled group by date),
joined as (select wide.*, p_win from wide join labels_daily on labels_daily.date = wide.date)"""

METRICS = f"""{OLS},
errors as (select y, p, y - p as e from fitted)"""


def _day(column: str = "date") -> str:
    return f"cast({column} as varchar) as date"


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_text": f"select doc_id, {_clean('text')} as cleaned from documents",
        "mention_flags": f"with {FLAGGED} select * from flagged",
        "compose_text": f"with {COMPOSED} select article_id, composed from composed",
        "prompt_template": f"""select doc_id, '[CLS] ' || text || ' [SEP] {A} [SEP]' as prompt
            from documents""",
        "search_articles": f"""with {ARTICLES}
            select article_id, title, epoch_us(published_at) as published_at from articles
            where language = 'en' and published_at >= timestamp '2024-01-02'
              and published_at < timestamp '2024-01-12'
              and ({" or ".join(f"{_mention('title', w)} = 1" for w in ("for", "is", "that"))})
              and ({" or ".join(f"{_mention('title', w)} = 1" for w in ("of the", "and the", "the", "with"))})""",
        "search_index_without": f"""with {ARTICLES}
            select article_id, title, epoch_us(published_at) as published_at from articles
            where language = 'en' and published_at >= timestamp '2024-01-02'
              and published_at < timestamp '2024-01-12'
              and ({" or ".join(f"{_mention('title', w)} = 1" for w in ("the", "and"))})
              and ({" or ".join(f"{_mention('title', w)} = 1" for w in ("of the", "is"))})
              and not ({" or ".join(f"{_mention('title', w)} = 1" for w in ("to the", "in"))})""",
        "tag_union_dedup": f"""with {MERGED}
            select tweet_id, tweet, country, epoch_us(created_at) as created_at,
              {_r("likes")} as likes, {_r("user_followers_count")} as user_followers_count,
              epoch_us(user_join_date) as user_join_date,
              cast(fa as bigint) as mentions_{A}, cast(fb as bigint) as mentions_{B}
            from merged""",
        "flag_propagation": f"""with {MERGED}
            select tweet_id, cast(source_rank as bigint) as source_rank,
              cast(max(mentions_{A}) over (partition by tweet_id) as bigint) as mentions_{A},
              cast(max(mentions_{B}) over (partition by tweet_id) as bigint) as mentions_{B}
            from tagged""",
        "account_age_filter": f"""with {POSTS}
            select tweet_id, {AGE} as account_age, {_r("likes")} as likes,
              {_r("user_followers_count")} as user_followers_count from posts
            where {AGE} > 2 and user_followers_count > 100 and likes > 5 and is_en""",
        "epoch_roundtrip": """select event_id, epoch_us(ts) // 1000 as ms,
            cast(cast(ts as date) as varchar) as day from events""",
        "parsed_timestamps": """select event_id,
              case when event_id % 7 <> 0 then epoch_us(ts) end as at,
              case when event_id % 7 <> 0 then epoch_us(date_trunc('minute', ts)) end as at_minute
            from events""",
        "parsed_dates": """select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day
            from orders""",
        "prepare_posts": f"""with {MERGED}, {IS_EN}
            select tweet_id, {_clean("tweet")} as textdata, epoch_us(created_at) as timestamp,
              cast(english.doc_id is not null as bigint) as is_en,
              cast(fa as bigint) as mentions_{A}, cast(fb as bigint) as mentions_{B}
            from merged left join english on english.doc_id = merged.tweet_id""",
        "prepare_articles": f"with {NEWS} select * from news",
        "language_profiles": f"""with {GRAMS}
            select counts.lang, gram, n, {_r("ln(n + 1) - log_total")} as log_prob
            from counts join totals on totals.lang = counts.lang""",
        "language_id": f"""with {IS_EN}
            select d.doc_id, cast(e.doc_id is not null as bigint) as is_en
            from documents d left join english e on e.doc_id = d.doc_id""",
        "language_id_by_join": f"""with {IS_EN} select doc_id, lang as language from best""",
        "lexicon_score": f"""with {SUMS}
            select d.doc_id, {_r(f"coalesce({COMPOUND}, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "lexicon_score_shifters": f"""with {SHIFTED}
            select d.doc_id, {_r(f"coalesce({COMPOUND}, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "phrase_score": f"""with {PHRASED}
            select d.doc_id, {_r(f"coalesce({COMPOUND}, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "phrase_score_shifters": f"""with {PHRASES_SHIFTED}
            select d.doc_id, {_r(f"coalesce({COMPOUND}, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "phrase_polarity": f"""with {PHRASED}
            select d.doc_id, {_r("coalesce(total / matched, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "mean_polarity": f"""with {SUMS}
            select d.doc_id, {_r("coalesce(total / matched, 0)")} as score
            from documents d left join sums on sums.doc_id = d.doc_id""",
        "sentiment_label": f"""with {SCORED}
            select doc_id, mentions_{A}, mentions_{B},
              {_r(f"{A}_score")} as {A}_sentiment_score, {_r(f"{B}_score")} as {B}_sentiment_score,
              {A}_label as {A}_sentiment_label, {B}_label as {B}_sentiment_label
            from scored""",
        "softmax_label": f"""with {SOFTMAX}
            select vec_id, {_r("e0 / (e0 + e1 + e2)")} as p_{NEG},
              {_r("e1 / (e0 + e1 + e2)")} as p_{NEU}, {_r("e2 / (e0 + e1 + e2)")} as p_{POS},
              case when e0 >= greatest(e1, e2) then '{NEG}' when e1 >= e2 then '{NEU}'
                   else '{POS}' end as sentiment_label
            from powers""",
        "aspect_batch": f"""with {SUMS}, {FLAGGED},
            means as (
              select f.*, coalesce(total / nullif(matched, 0), 0) as mean
              from flagged f left join sums s on s.doc_id = f.doc_id),
            named as (select *, case when mean <= -{BAND} then '{NEG}' when mean > {BAND} then '{POS}'
              else '{NEU}' end as label from means)
            select doc_id, case when mentions_{A} = 1 then label end as {A}_sentiment_label,
              case when mentions_{B} = 1 then label end as {B}_sentiment_label from named""",
        "aspect_prompt": f"""with {PROMPT_SUMS}, {FLAGGED},
            means as (
              select f.doc_id, mentions_{A}, mentions_{B},
                {", ".join(
                    f"(coalesce(total, 0) + {v}) / (coalesce(matched, 0) + 1) as {e}_mean"
                    for e, v in ASPECT_VALENCES.items()
                )}
              from flagged f left join sums s on s.doc_id = f.doc_id)
            select doc_id, {", ".join(
                f"case when mentions_{e} = 1 then case when {e}_mean <= -{BAND} then '{NEG}' "
                f"when {e}_mean > {BAND} then '{POS}' else '{NEU}' end end as {e}_sentiment_label"
                for e in ENTITIES
            )} from means""",
        "unpivot_entities": f"""with {SCORED}
            select doc_id, '{A}' as candidate, {A}_label as sentiment_label
            from scored where mentions_{A} = 1
            union all select doc_id, '{B}', {B}_label from scored where mentions_{B} = 1""",
        "entity_summary": f"""with {SCORED}
            select '{A}' as entity, count(*) as mentions, {_r(f"avg({A}_score)")} as mean_score
            from scored where mentions_{A} = 1
            union all
            select '{B}', count(*), {_r(f"avg({B}_score)")} from scored where mentions_{B} = 1""",
        "label_counts": f"""with {SCORED}
            select {A}_label as sentiment_label, count(*) as n from scored
            where mentions_{A} = 1 group by 1""",
        "daily_ratio_long": f"""with {RATIOS}
            select {_day()}, candidate, cast(total as bigint) as sum, n as count,
              {_r("ratio")} as ratio from ratios""",
        "daily_ratio_pivot": f"""with {FEATURES}
            select {_day()}, {_r(C)} as {C}, {_r(V)} as {V} from wide""",
        "daily_ratio_one": f"""with {RATIOS}
            select {_day()}, cast(total as bigint) as sum, n as count, {_r("ratio")} as ratio
            from ratios where candidate = '{C}'""",
        "daily_ratio_wide": f"""with {SCORED_POSTS}
            select {_day()}, {_r(f"avg({_indicator(f'{A}_label')})")} as {A}_ratio,
              {_r(f"avg({_indicator(f'{B}_label')})")} as {B}_ratio
            from scored_posts group by scored_posts.date""",
        "daily_ratio_wide_mentions": f"""with {SCORED_POSTS}
            select {_day()},
              {_r(f"avg(case when mentions_{A} = 1 then {_indicator(f'{A}_label')} end)")}
                as {A}_ratio,
              {_r(f"avg(case when mentions_{B} = 1 then {_indicator(f'{B}_label')} end)")}
                as {B}_ratio
            from scored_posts group by scored_posts.date""",
        "daily_mean": f"""with {RATIOS}
            select {_day()}, candidate, {_r("ratio")} as sentiment_indic from ratios""",
        "candidate_indicator": f"""select event_id,
              cast(case when event_type = '{C}' then 1 else 0 end as bigint) as about,
              cast(case when value >= 60 then 1 when value <= 20 then -1 end as bigint)
                as indicator
            from events""",
        "rolling_mean": f"""with {RATIOS}
            select {_day()}, candidate, {_r('''avg(ratio) over (order by ratios.date, candidate
              rows between 6 preceding and current row)''')} as rolling from ratios""",
        "rolling_mean_per_entity": f"""with {RATIOS}
            select {_day()}, candidate, {_r('''avg(ratio) over (partition by candidate
              order by ratios.date rows between 6 preceding and current row)''')} as rolling
            from ratios""",
        "softsign_measures": f"""with {RATIOS}
            select {_day()}, candidate, {_r("ratio / (abs(ratio) + 1)")} as softsign,
              {_r("1 - ratio")} as complement,
              cast(case when ratio > -0.2 then 1 else 0 end as bigint) as above from ratios""",
        "forecast_labels": f"""with long as (
              select cast(o_orderdate as date) as date, o_orderstatus as status,
                avg(o_totalprice) / 1000000 as value
              from orders where o_orderpriority = '4-NOT SPECIFIED' group by 1, 2)
            select {_day()},
              {_r("coalesce(max(value) filter (where status = 'F'), 0)")} as p_win,
              {_r('''coalesce(max(value) filter (where status = 'O'), 0)
                + coalesce(max(value) filter (where status not in ('F', 'O')), 0)''')} as p_lose
            from long group by long.date""",
        "topline_labels": f"""select cast(cast(o_orderdate as date) as varchar) as date,
              {_r("avg(case when o_orderstatus = 'F' then cast(1 as double) else 0 end)")} as p_win,
              {_r("avg(case when o_orderstatus = 'O' then cast(1 as double) else 0 end)")} as p_lose
            from orders group by 1""",
        "features_two_ratios": f"""with {FEATURES}
            select {_day()}, {_r(C)} as {C}, {_r(V)} as {V}, {_r("p_win")} as p_win
            from features""",
        "features_one_ratio": f"""with {RATIOS}, {LABELS}
            select cast(ratios.date as varchar) as date, {_r("ratio")} as ratio,
              {_r("p_win")} as p_win
            from ratios join labels_daily on labels_daily.date = ratios.date
            where candidate = '{C}'""",
        "news_two_ratios": f"""with {SCORED_POSTS}, {LABELS},
            daily as (select date, avg({_indicator(f"{A}_label")}) as a,
              avg({_indicator(f"{B}_label")}) as b from scored_posts group by date)
            select cast(daily.date as varchar) as date, {_r("a")} as {A}_ratio,
              {_r("b")} as {B}_ratio, {_r("p_win")} as p_win
            from daily join labels_daily on labels_daily.date = daily.date""",
        "news_one_ratio": f"""with {SCORED_POSTS}, {LABELS},
            daily as (select date, avg({_indicator(f"{A}_label")}) as a
              from scored_posts where mentions_{A} = 1 group by date)
            select cast(daily.date as varchar) as date, {_r("a")} as ratio, {_r("p_win")} as p_win
            from daily join labels_daily on labels_daily.date = daily.date""",
        "enhanced_features": f"""with {ENHANCED}
            select {_day()}, {", ".join(
                f"{_r(column.format(e))} as {name.format(e)}"
                for column, name in (
                    ('"{}"', '"{}"'), ("{}_mean", "{}_sentiment_indic"),
                    ("{}_rolling", "{}_rolling_sentiment_indic"))
                for e in ENTITIES)},
              {_r("p_win")} as p_win, {_r('''avg(p_win) over (order by joined.date
                rows between 6 preceding and current row)''')} as p_win_rolling
            from joined""",
        "ols_no_intercept": f"""with {OLS}
            select '{C}' as feature, {_r("b1")} as beta,
              {_r("(b1 * s1y + b2 * s2y) / syy")} as r2 from betas
            union all select '{V}', {_r("b2")}, {_r("(b1 * s1y + b2 * s2y) / syy")} from betas""",
        "linear_fit": _one_feature("sxy / sxx"),
        "ridge_fit": _one_feature("sxy / (sxx + 2)"),
        "lasso_fit": _one_feature("sign(sxy) * greatest(abs(sxy) / n - 0.0005, 0) / (sxx / n)"),
        "linear_fit_two": _two_features(*_ridge_slopes(0)),
        "ridge_fit_two": _two_features(*_ridge_slopes(2)),
        "lasso_fit_two": _two_features(LASSO_KEEPS, LASSO_DROPS),
        "penalty_path": f"""with {PATH} {" union all ".join(
            f"select label, model, {_r('alpha')} as alpha, '{name}' as feature, {_r(b)} as beta, {_r('r2')} as r2 from path"
            for name, b in (("price", "b1"), ("tax", "b2"), ("intercept", "b0")))}""",
        "rolling_target_fit": _two_features(*_ridge_slopes(0)).replace(SALES, SALES_ROLLED),
        "gbt_stump": f"""with items as (
              select l_extendedprice / 100000 as y, l_discount, l_quantity, l_tax from lineitem),
            long as ({" union all ".join(
                f"select {k} as place, '{c}' as feature, {c} as x, y from items"
                for k, c in enumerate(("l_discount", "l_quantity", "l_tax")))}),
            vals as (select place, feature, x, count(*) as n, sum(y) as s from long group by 1, 2, 3),
            sides as (
              select *, sum(n) over lower as ln, sum(s) over lower as ls, sum(n) over feat as alln,
                sum(s) over feat as alls, (x + lead(x) over (partition by place order by x)) / 2 as cut
              from vals window feat as (partition by place),
                lower as (partition by place order by x rows unbounded preceding)),
            gains as (
              select *, ls * ls / ln + (alls - ls) * (alls - ls) / (alln - ln) as gain
              from sides where cut is not null)
            select feature, {_r("cut")} as threshold, {_r("ls / ln")} as below,
              {_r("(alls - ls) / (alln - ln)")} as above
            from gains order by gain desc limit 1""",
        "scenario_grid_linear": f"""with {GRID}
            select split, sentiment, features, model, options, 'train' as evaluated_on, count(*) as n,
              {_r("avg(case when (y > 0.5) = (p > 0.5) then cast(1 as double) else 0 end)")} as accuracy,
              {_r("coalesce(avg(case when p < 0.5 then cast(1 as double) else 0 end) filter (where y < 0.5), 0)")}
                as below_accuracy,
              {_r("coalesce(avg(case when p >= 0.5 then cast(1 as double) else 0 end) filter (where y >= 0.5), 0)")}
                as above_accuracy,
              {_r("avg(abs(y - p))")} as mae, {_r("sqrt(avg((y - p) * (y - p)))")} as rmse,
              {_r("1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))")} as r2,
              {_r("avg(abs((y - p) / y)) * 100")} as mape
            from guessed group by split, sentiment, features, model, options""",
        "arimax_fit": f"""with {SERIES}, {ARIMAX}
            select 'discount' as feature, {_r("beta")} as beta from b_x
            union all select 'ar1', {_r("beta")} from b_ar
            union all select 'ma1', {_r("beta")} from b_ma""",
        "ols_predictions": f"""with {OLS}
            select {_day()}, {_r("y")} as p_win, {_r("p")} as prediction from fitted""",
        "eval_metrics": f"""with {METRICS}
            select count(*) as n,
              {_r("avg(case when (y > 0.5) = (p > 0.5) then cast(1 as double) else 0 end)")}
                as accuracy,
              {_r("avg(abs(e))")} as mae, {_r("sqrt(avg(e * e))")} as rmse,
              {_r("1 - sum(e * e) / (var_pop(y) * count(*))")} as r2,
              {_r("avg(abs(e / y)) * 100")} as mape from errors""",
        "class_accuracy": f"""with {METRICS}
            select count(*) as n,
              {_r("coalesce(avg(case when p < 0.5 then cast(1 as double) else 0 end) filter (where y < 0.5), 0)")}
                as below_accuracy,
              {_r("coalesce(avg(case when p >= 0.5 then cast(1 as double) else 0 end) filter (where y >= 0.5), 0)")}
                as above_accuracy from errors""",
        "class_counts": f"""with {METRICS}
            select 'actual' as kind, cast(case when y > 0.5 then 1 else 0 end as bigint) as class,
              count(*) as n from errors group by 2
            union all
            select 'predicted', cast(case when p > 0.5 then 1 else 0 end as bigint), count(*)
            from errors group by 2""",
        "news_run": f"""with {SUMS}, {FLAGGED},
            polar as (
              select f.*, case when mentions_{A} = 1 then coalesce(total / matched, 0) else 0 end
                as a, case when mentions_{B} = 1 then coalesce(total / matched, 0) else 0 end as b
              from flagged f left join sums s on s.doc_id = f.doc_id),
            {POSTS}, {LABELS},
            daily as (
              select cast(created_at as date) as date, avg({_indicator(f"({_label('a')})")}) as x1,
                avg({_indicator(f"({_label('b')})")}) as x2
              from polar join posts on posts.tweet_id = polar.doc_id group by 1),
            filled as (select x1, x2, p_win as y
              from daily join labels_daily on labels_daily.date = daily.date),
            {OLS[OLS.index("moments as"):OLS.index("fitted as")].rstrip().rstrip(",")}
            select '{A}_ratio' as feature, {_r("b1")} as beta,
              {_r("(b1 * s1y + b2 * s2y) / syy")} as r2 from betas
            union all
            select '{B}_ratio', {_r("b2")}, {_r("(b1 * s1y + b2 * s2y) / syy")} from betas""",
        "posts_csv": f"""with {POSTS}
            select epoch_us(created_at) as created_at, tweet_id, tweet, {_r("likes")} as likes,
              epoch_us(user_join_date) as user_join_date,
              {_r("user_followers_count")} as user_followers_count, country from posts""",
        "sentiment_table": f"""with {SCORED_POSTS}
            select doc_id as tweet_id, {_day()}, {A}_label as {A}_sentiment_label,
              {B}_label as {B}_sentiment_label
            from scored_posts""",
        "articles_json": f"""with {ARTICLES}
            select cast(article_id as varchar) as uuid, title, description,
              epoch_us(published_at) as published_at from articles""",
        "article_pages": f"""with {ARTICLES}
            select article_id as uuid, title, description, epoch_us(published_at) as published_at
            from articles""",
        "stored_predictions": f"""with {OLS},
            centred as (
              select avg(x1) as m1, avg(x2) as m2, avg(y) as my, regr_sxx(y, x1) as s11, regr_sxx(y, x2) as s22,
                regr_sxy(x1, x2) as s12, regr_sxy(y, x1) as s1y, regr_sxy(y, x2) as s2y from filled),
            slopes as (
              select name, m1, m2, my, (s1y * (s22 + alpha) - s2y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as b1,
                (s2y * (s11 + alpha) - s1y * s12) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) as b2
              from centred, (values ('linear', cast(0 as double)), ('ridge', cast(2 as double))) a(name, alpha))
            select {_day()}, 'train/VADER_2RATIOS_ols_no_intercept' as run, {_r("p")} as prediction from fitted
            union all
            select {_day()}, 'train/VADER_2RATIOS_' || name, {_r("my + b1 * (x1 - m1) + b2 * (x2 - m2)")}
            from filled, slopes""",
        "params_table": f"""with {OLS}
            select 'betas' as params, {_r("b1")} as {C}, {_r("b2")} as {V} from betas""",
    }
    for trade, column in (("close", "l_discount"), ("average", "l_tax")):
        sql[f"market_labels_{trade}"] = f"""select cast(cast(l_shipdate as date) as varchar) as date,
            {_r(f"avg({column})")} as p_win, {_r(f"1 - avg({column})")} as p_lose
            from lineitem group by 1"""
    news = f"with {NEWS} select textdata, timestamp // 1000 as timestamp, mentions_{A}, mentions_{B} from news"
    sql["news_records_json"] = sql["nested_json"] = news
    sql["search_index"] = sql["search_articles"]
    sql["collected_pages"] = sql["article_pages"]
    sql["news_run_market_only"] = sql["news_run"]
    sql["sentiment_days"] = sql["sentiment_table"]
    sql["merged_batches"] = sql["tag_union_dedup"]
    sql["articles_array_ranges"] = sql["articles_json"]
    sql["articles_array_json"] = sql["articles_json"]
    sql["posts_csv_wide"] = sql["posts_csv"]
    sql["toplines_csv"] = sql["topline_labels"]
    key = "case doc_id % 3 when 1 then doc_id % 50 when 2 then doc_id end as key, doc_id"
    scores, flags = sql["lexicon_score"], sql["language_id"]
    sql["lexicon_score_by_row"] = f"select {key}, score from ({scores})"
    sql["language_id_by_row"] = f"select {key}, is_en as in_place, is_en as by_join from ({flags})"
    sql["phrase_score_by_join"] = sql["phrase_score"]
    sql["lexicon_score_by_join"] = sql["lexicon_score_shifters"]
    sql["feature_export"] = sql["features_two_ratios"]
    return sql
