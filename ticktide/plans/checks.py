"""SQL checks of the registered queries, for DuckDB over the same tables.

Written independently of the queries: where Spark aggregates, these rank or join, and the reverse.
"""

from __future__ import annotations

from ticktide.functions import sentiment as rules
from ticktide.functions.sentiment import Rules
from ticktide.models.learners import LinearLearner, NetworkLearner
from ticktide.operators.weather import PAIR_MEASURES
from ticktide.plans import views
from ticktide.schemas import CITIES, FEATURE_COLUMNS, MEASURES, WEATHER_COLUMNS

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"
START, END = (f"TIMESTAMP '{text}'" for text in ("2024-01-08 00:00:00", "2024-01-22 12:00:00"))


def source(text: str) -> str:
    return text.replace("{events}", "events").replace("{conversations}", "conversations")


def with_parts(query: str, *names: str, **extra: str) -> str:
    """The query behind the common table expressions it names, with those they need, and ``extra`` ones."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name not in ordered:
            for other in NEEDS.get(name, ()):
                need(other)
            ordered.append(name)

    for name in names:
        need(name)
    texts = {**{name: PARTS[name] for name in ordered}, **extra}
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in texts.items()) + f"\n{query}"


def words_in(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{name}'" for name in names)


TEST = Rules(
    negators=("not", "by", "his"), intensifiers=("very", "are", "this"), dampeners=("hardly", "on", "as"), contrast="with"
)
# Leading or trailing ASCII punctuation, for the regular expressions of DuckDB.
EDGES = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"


def with_phrases(words: str) -> str:
    """A list of words with those of each test phrase joined: the leftmost, of these the longest, as a regular expression
    finds them. Control characters stand around words (1, 2) and found phrases (3, 4)."""
    known = sorted((line.split("'")[1] for line in views.PHRASES.split("(")[2:] if "'" in line), key=lambda p: (-len(p.split()), p))
    forms = "|".join("".join(f"\\x01{word}\\x02" for word in phrase.split()) for phrase in known)
    line = f"array_to_string(list_transform({words}, lambda w: chr(1) || w || chr(2)), '')"
    marked = f"regexp_replace({line}, '({forms})', chr(3) || '\\1' || chr(4), 'gi')"
    joined = f"""array_to_string(list_transform(string_split({marked}, chr(3)), lambda p: CASE WHEN contains(p, chr(4))
        THEN replace(string_split(p, chr(4))[1], chr(2) || chr(1), chr(8288)) || string_split(p, chr(4))[2] ELSE p END), '')"""
    return f"list_filter(list_transform(string_split({joined}, chr(1)), lambda w: replace(w, chr(2), '')), lambda w: w <> '')"


def scored(table: str, ids: str, text: str, lexicon: str = "lexicon", held=lambda words: words) -> str:
    """Rule-based sentiment with words as rows and windows over them."""
    caps = f"({rules.CAPS_GAIN})"
    words = f"""list_transform(list_filter(regexp_split_to_array(coalesce({text}, ''), '\\s+'), lambda w: w <> ''),
                              lambda w: CASE WHEN length(regexp_replace(w, '{EDGES}', '', 'g')) > 2
                                             THEN regexp_replace(w, '{EDGES}', '', 'g') ELSE w END)"""
    b = [f"coalesce(lag(degree, {back}) OVER w, 0.0) * {decay} AS d{back}" for back, decay in ((1, 1.0), (2, 0.95), (3, 0.9))]
    n = [f"coalesce(lag(negated, {back}) OVER w, false) AS n{back}" for back in (1, 2, 3)]
    step = "v0"
    for back in (1, 2, 3):
        step = f"(({step}) + sign({step}) * d{back}) * (CASE WHEN n{back} THEN {rules.NEGATION_FACTOR} ELSE 1.0 END)"
    return f"""
    WITH texts AS (
        SELECT {ids}, coalesce({text}, '') AS body,
               {held(words)} AS words
        FROM {table}),
    w0 AS (
        SELECT {ids}, unnest(words) AS word, generate_subscripts(words, 1) AS spot,
               list_position(list_transform(words, lambda w: lower(w)), '{TEST.contrast}') AS contrast_at,
               len(list_filter(words, lambda w: w = upper(w) AND w <> lower(w))) AS n_loud, len(words) AS n_words
        FROM texts),
    w1 AS (
        SELECT *, lower(word) AS token, word = upper(word) AND word <> lower(word) AND n_loud < n_words AS shouted FROM w0),
    w2 AS (
        SELECT *, lower(word) IN ({words_in(TEST.negators)}) OR contains(lower(word), 'n''t') AS negated,
               CASE WHEN token IN ({words_in(TEST.intensifiers)}) THEN {rules.DEGREE_GAIN}
                    WHEN token IN ({words_in(TEST.dampeners)}) THEN -{rules.DEGREE_GAIN} END
               + CASE WHEN shouted THEN {rules.CAPS_GAIN} ELSE 0.0 END AS degree
        FROM w1),
    w3 AS (SELECT *, {', '.join(b)}, {', '.join(n)} FROM w2 WINDOW w AS (PARTITION BY {ids} ORDER BY spot)),
    w4 AS (
        SELECT {ids}, spot, contrast_at, valence + sign(valence) * CASE WHEN shouted THEN {caps} ELSE 0.0 END AS v0,
               d1, d2, d3, n1, n2, n3, degree
        FROM w3 JOIN {lexicon} USING (token) WHERE degree IS NULL OR degree = 0),
    totals AS (
        SELECT {ids}, sum(({step}) * CASE WHEN coalesce(contrast_at, 0) = 0 OR spot = contrast_at THEN 1.0
                                          WHEN spot < contrast_at THEN {rules.BEFORE_CONTRAST}
                                          ELSE {rules.AFTER_CONTRAST} END) AS total
        FROM w4 GROUP BY ALL),
    loud AS (
        SELECT {ids}, coalesce(total, 0.0) AS total,
               least(len(body) - len(replace(body, '!', '')), {rules.EXCLAMATION_MAX}) * {rules.EXCLAMATION_GAIN}::DOUBLE
               + CASE WHEN len(body) - len(replace(body, '?', '')) <= 1 THEN 0.0
                      WHEN len(body) - len(replace(body, '?', '')) <= {rules.QUESTION_MAX}
                      THEN (len(body) - len(replace(body, '?', ''))) * {rules.QUESTION_GAIN}::DOUBLE
                      ELSE {rules.QUESTION_CAP} END AS strength
        FROM texts LEFT JOIN totals USING ({ids})),
    summed AS (SELECT {ids}, total + sign(total) * strength AS s FROM loud)
    SELECT {ids}, round(greatest(-1.0, least(1.0, s / sqrt(s * s + {rules.NORMALISER}))), 4) AS sentiment FROM summed"""


def pivoted(rows: str = "weather") -> str:
    measures = {"tem": "temp - 273.15", "hum": "CAST(humidity AS DOUBLE)", "wind": "wind_speed"}
    cells = ", ".join(
        f"max({measures[prefix]}) FILTER (country = '{code}') AS {prefix}_{city}"
        for code, (city, _) in CITIES.items()
        for prefix in MEASURES
    )
    return f"SELECT hour, {cells} FROM {rows} GROUP BY hour"


CONTEXT = [*WEATHER_COLUMNS, "sentiment"]
FILLED = ", ".join(f"last_value({name} IGNORE NULLS) OVER upto AS {name}" for name in CONTEXT)

PARTS = {
    "ticks": source(views.TICKS),
    "trades": source(views.TRADES.replace("{ticks}", views.TICKS)),
    "quotes": source(views.QUOTES.replace("{ticks}", views.TICKS)),
    # of quotes at one time the last, and the first
    "last_quotes": "SELECT symbol, quoted_at, max(quote_id) AS quote_id, arg_max(bid, quote_id) AS bid FROM quotes GROUP BY ALL",
    "first_quotes": "SELECT symbol, quoted_at, min(quote_id) AS quote_id, arg_min(bid, quote_id) AS bid FROM quotes GROUP BY ALL",
    "posts": source(views.POSTS_FLAT),
    "comments": source(views.COMMENTS_FLAT),
    "weather": source(views.WEATHER_FLAT),
    "lexicon": views.LEXICON,
    "parsed": """
        SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN symbol END AS symbol,
               CASE WHEN event_id % 97 <> 0 AND event_id % 101 <> 0 THEN price END AS price,
               CASE WHEN event_id % 97 <> 0 THEN event_time END AS event_time FROM ticks""",
    "usable": "SELECT * FROM parsed WHERE symbol IS NOT NULL AND price IS NOT NULL",
    "post_scored": scored("posts", "post_id", "post_title"),
    "comment_scored": scored("comments", "comm_id", "comm_body"),
    "moods": """
        SELECT date_trunc('hour', make_timestamp(CAST(post_time AS BIGINT) * 1000000)) + after * INTERVAL 1 HOUR AS hour,
               floor((200 * sum(CAST(round(sentiment * 10000) AS BIGINT)) + count(*)) / (2.0 * count(*))) / 1000000.0 AS sentiment
        FROM posts JOIN post_scored USING (post_id), unnest(generate_series(24, 48)) AS t(after) GROUP BY 1""",
    "comment_mood": """
        SELECT p.post_id,
               round(coalesce(sum(s.sentiment * greatest(c.comm_score, 0)) / (sum(greatest(c.comm_score, 0)) + 1e-12)
                              / count(c.comm_id), 0.0), 6) AS comments_sentiment
        FROM posts p LEFT JOIN comments c USING (post_id) LEFT JOIN comment_scored s USING (comm_id) GROUP BY 1""",
    "wide": pivoted(),
    "context": f"""
        SELECT * FROM (
            SELECT hour, {FILLED} FROM (SELECT hour FROM wide UNION SELECT hour FROM moods)
            LEFT JOIN wide USING (hour) LEFT JOIN moods USING (hour)
            WINDOW upto AS (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "lags": """
        SELECT *, date_trunc('hour', event_time) AS hour, lag(price, 1) OVER w AS price_1, lag(price, 2) OVER w AS price_2,
               lag(price, 1) OVER w - lag(price, 2) OVER w AS currency_diff
        FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id)""",
    "hour_last": """
        SELECT symbol, date_trunc('hour', event_time) AS hour, arg_max(price, event_time) AS last_price
        FROM ticks GROUP BY ALL""",
    "deltas": """
        SELECT t.event_id, t.symbol, date_trunc('hour', t.event_time) AS hour, t.price,
               (SELECT arg_max(h.last_price, h.hour) FROM hour_last h
                WHERE h.symbol = t.symbol AND h.hour < date_trunc('hour', t.event_time)) AS previous_price
        FROM ticks t""",
    "featured": f"""
        SELECT l.event_id, l.symbol, l.event_time, l.hour, l.price, round(l.currency_diff, 6) AS currency_diff,
               {', '.join(f'round(c.{name}, 6) AS {name}' for name in CONTEXT)},
               round(d.price - d.previous_price, 6) AS y
        FROM lags l JOIN deltas d USING (event_id) ASOF LEFT JOIN context c ON l.hour >= c.hour""",
    "full_rows": f"SELECT * FROM featured WHERE {' AND '.join(f'{name} IS NOT NULL' for name in [*FEATURE_COLUMNS, 'y'])}",
    "predicted": f"""
        SELECT *, round({' + '.join(f'{name} * {weight}' for name, weight in views.FIXED_MODEL.items())}, 6) AS y_hat
        FROM full_rows""",
    "errors": """
        SELECT hour, round_even(avg((y - y_hat) ** 2), 0) AS mse, round(avg((y - y_hat) ** 2), 6) AS mse_exact
        FROM predicted GROUP BY 1""",
    "results": f"""
        SELECT {', '.join(f'CAST({name} AS FLOAT) AS {name}' for name in FEATURE_COLUMNS)}, y, y_hat, mse,
               epoch(hour) AS time_stamp, hour AS date
        FROM (SELECT * FROM predicted QUALIFY row_number() OVER (PARTITION BY hour ORDER BY event_time, event_id) = 1)
        JOIN errors USING (hour)""",
}

NEEDS = {
    "last_quotes": ("quotes",),
    "first_quotes": ("quotes",),
    "parsed": ("ticks",),
    "usable": ("parsed",),
    "post_scored": ("posts", "lexicon"),
    "comment_scored": ("comments", "lexicon"),
    "moods": ("posts", "post_scored"),
    "comment_mood": ("posts", "comments", "comment_scored"),
    "wide": ("weather",),
    "context": ("wide", "moods"),
    "lags": ("ticks",),
    "hour_last": ("ticks",),
    "deltas": ("ticks", "hour_last"),
    "featured": ("lags", "deltas", "context"),
    "full_rows": ("featured",),
    "predicted": ("full_rows",),
    "errors": ("predicted",),
    "results": ("predicted", "errors"),
}

BASE = "CASE WHEN symbol IS NOT NULL THEN string_split(symbol, 'USDT')[1] END AS base"
QUOTE = "CASE WHEN contains(symbol, 'USDT') THEN string_split(symbol, 'USDT')[2] END AS quote"
RESULTS_LIST = ", ".join([*FEATURE_COLUMNS, "y", "y_hat", "mse", "time_stamp"])
HOUR_KEY = "strftime(make_timestamp(CAST(post_time AS BIGINT) * 1000000), '%Y-%m-%d-%H')"


LAST_QUOTE = with_parts(
    """SELECT t.event_id, t.symbol, t.price, q.quote_id, q.bid
       FROM trades t ASOF LEFT JOIN last_quotes q ON t.symbol = q.symbol AND t.event_time >= q.quoted_at""", "trades", "last_quotes"
)


def histogram(values: str, bins: str, *names: str, label: str = "") -> str:
    """Counts in equal bins of column ``v`` of the query ``values``."""
    query = f"""
    SELECT {label} CAST(slots.bin AS BIGINT) AS bin, round(lo + (slots.bin - 1) * ((hi - lo) / bins), 6) AS bin_start,
           round(lo + slots.bin * ((hi - lo) / bins), 6) AS bin_end, count(put.bin) AS count
    FROM span, slots LEFT JOIN put ON put.bin = slots.bin GROUP BY ALL"""
    return with_parts(
        query,
        *names,
        vs=values,
        span=f"SELECT min(v)::DOUBLE AS lo, max(v)::DOUBLE AS hi, ({bins})::BIGINT AS bins FROM vs",
        slots="SELECT unnest(generate_series(1, (SELECT bins FROM span))) AS bin",
        put="SELECT least(CAST(floor((v - lo) / ((hi - lo) / bins)) AS BIGINT) + 1, bins) AS bin FROM vs, span",
    )


AUTO_BINS = """
    SELECT CASE WHEN span = 0 THEN 1 ELSE ceil(span / least(span / (log2(n) + 1),
                coalesce(2 * nullif(spread, 0) / n ** (1.0 / 3), span / (log2(n) + 1)))) END
    FROM (SELECT max(v) - min(v) AS span, count(*) AS n, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS spread FROM vs)"""

TOP_DROPPED = """
    SELECT comm_id, comm_score FROM (
        SELECT *, row_number() OVER (ORDER BY comm_score DESC, comm_id) AS place FROM comments) WHERE place > 3"""

# A double as the JSON writer prints it: 1.70406726E9.
JSON_TIME = "'1.' || rtrim(substr(CAST(CAST(comm_time_utc AS BIGINT) AS VARCHAR), 2), '0') || 'E9'"


def sgd_weights(also: str = "") -> str:
    """Weights after one step from zero: -rate times the mean of -y times the standardised input."""
    rate = 0.01
    terms = [
        f"SELECT '{name}' AS input, {rate} * avg(y * ({name} - m_{name}) / CASE WHEN s_{name} > 0 THEN s_{name} ELSE 1 END) AS w "
        f"FROM full_rows, moments"
        for name in FEATURE_COLUMNS
    ]
    union = " UNION ALL ".join([*terms, f"SELECT 'intercept', {rate} * avg(y) FROM full_rows"])
    moments = ", ".join(f"avg({name}) AS m_{name}, stddev_pop({name}) AS s_{name}" for name in FEATURE_COLUMNS)
    return with_parts(
        f"SELECT input, round(w, 6) AS weight{also} FROM ({union})", "full_rows", moments=f"SELECT {moments} FROM full_rows"
    )


def network_step() -> str:
    """Weights of the network after one step: forward and backward pass as sums over (row, unit), then Adam."""
    learner = NetworkLearner()
    layers = learner.layers(learner.start().weights)
    values = ", ".join(
        f"({at}, {i}, {j}, {float(weight)!r})"
        for at, layer in enumerate(layers) for i, row in enumerate(layer) for j, weight in enumerate(row)
    )
    scaled = [f"(({name} - avg({name}) OVER ()) / coalesce(nullif(stddev_pop({name}) OVER (), 0), 1))" for name in FEATURE_COLUMNS]
    parts = {
        "w": f"SELECT * FROM (VALUES {values}) AS t(layer, i, j, weight)",
        "inputs": f"SELECT row_number() OVER () AS row, y, [{', '.join(scaled)}, 1.0] AS x FROM full_rows",
        "v0": "SELECT row, unnest(generate_series(0, len(x) - 1)) AS i, unnest(x) AS v FROM inputs",
    }
    last = len(layers) - 1
    for at, layer in enumerate(layers[:-1]):
        parts[f"s{at + 1}"] = f"SELECT row, j AS i, greatest(sum(v * weight), 0) AS v FROM v{at} JOIN w USING (i) WHERE layer = {at} GROUP BY ALL"
        parts[f"v{at + 1}"] = f"FROM s{at + 1} UNION ALL SELECT row, {layer.shape[1]}, 1.0 FROM inputs"
    parts[f"d{last}"] = f"""SELECT row, 0 AS j, sum(v * weight) - any_value(y) AS d FROM v{last} JOIN w USING (i) JOIN inputs USING (row)
                            WHERE layer = {last} GROUP BY ALL"""
    for at in range(last, 0, -1):
        parts[f"d{at - 1}"] = f"""SELECT s.row, s.i AS j, sum(d * weight) * any_value(CAST(s.v > 0 AS INT)) AS d
            FROM s{at} s JOIN w ON w.layer = {at} AND w.i = s.i JOIN d{at} b ON b.row = s.row AND b.j = w.j GROUP BY ALL"""
    slopes = " UNION ALL ".join(
        f"SELECT {at} AS layer, i, j, sum(v * d) / (SELECT count(*) FROM inputs) AS g FROM v{at} JOIN d{at} USING (row) GROUP BY i, j"
        for at in range(len(layers))
    )
    ends = [0]
    for layer in layers:
        ends.append(ends[-1] + layer.size)
    offset = " ".join(f"WHEN {at} THEN {ends[at]} + i * {layer.shape[1]} + j" for at, layer in enumerate(layers))
    bias = " ".join(f"WHEN {at} THEN i = {len(layer) - 1}" for at, layer in enumerate(layers))
    first, second = learner.betas
    correction = (1 - second) ** 0.5 / (1 - first)
    parts["slopes"] = f"""SELECT layer, i, j, weight, g + CASE WHEN CASE layer {bias} END THEN 0 ELSE {learner.penalty} * weight END AS g
                          FROM ({slopes}) JOIN w USING (layer, i, j)"""
    return with_parts(
        f"""SELECT CAST(CASE layer {offset} END AS INT) AS at,
                   round(weight - {learner.rate * correction!r} * {1 - first!r} * g / (sqrt({1 - second!r} * g * g) + {learner.epsilon}), 6) AS weight
            FROM slopes""", "full_rows", **parts)


def online_sgd(slices: int = 4) -> str:
    """Results of the linear model's test-then-train stream: a chain of batches, each with the weights and the
    moments that the batches before it left. Batch 0 has no earlier prices and thus no rows to learn from."""
    learner, x = LinearLearner(), FEATURE_COLUMNS
    parts = {
        "cuts": f"""SELECT epoch_us(min(event_time)) AS low,
                           CAST(round_even((epoch_us(max(event_time)) - epoch_us(min(event_time))) / {float(slices)}, 0) AS BIGINT) AS step
                    FROM ticks""",
        "sliced": f"""SELECT *, {' + '.join(f'CAST(epoch_us(event_time) >= low + {at} * step AS INT)' for at in range(1, slices))} AS batch
                      FROM usable, cuts""",
        "last_of": "SELECT symbol, batch, arg_max(price, event_time) AS price FROM sliced GROUP BY ALL",
        "moved": """SELECT *, lag(price, 1) OVER w - lag(price, 2) OVER w AS currency_diff,
                           price - (SELECT arg_max(l.price, l.batch) FROM last_of l WHERE l.symbol = s.symbol AND l.batch < s.batch) AS y
                    FROM sliced s WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id)""",
        "r": f"""SELECT batch, event_id, event_time, y, currency_diff, {', '.join(f'c.{name}' for name in CONTEXT)}
                 FROM moved m ASOF LEFT JOIN context c ON date_trunc('hour', m.event_time) >= c.hour
                 WHERE {' AND '.join(f'{name} IS NOT NULL' for name in [*x, 'y'])}""",
        "w1": "SELECT " + ", ".join(f"0.0::DOUBLE AS w_{name}" for name in [*x, "bias"]),
    }
    found = []
    for at in range(1, slices):
        rate = f"({learner.rate} / {at} ** {learner.power}::DOUBLE)"
        seen = f"batch < {at}" if at > 1 else "batch = 1"
        moments = ", ".join(f"avg({n}) AS a_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}" for n in x)
        parts[f"m{at}"] = f"SELECT {moments} FROM r WHERE {seen}"
        scaled = ", ".join(f"({n} - a_{n}) / s_{n} AS z_{n}" for n in x)
        parts[f"z{at}"] = f"SELECT r.*, {scaled} FROM r, m{at} WHERE batch = {at}"
        parts[f"e{at}"] = f"""SELECT *, y_hat - y AS error FROM (
            SELECT z.*, w_bias + {' + '.join(f'w_{n} * z_{n}' for n in x)} AS y_hat FROM z{at} z, w{at})"""
        steps = [f"any_value(w_{n}) - {rate} * (avg(error * z_{n}) + {learner.penalty} * any_value(w_{n})) AS w_{n}" for n in x]
        parts[f"w{at + 1}"] = f"SELECT {', '.join(steps)}, any_value(w_bias) - {rate} * avg(error) AS w_bias FROM e{at}, w{at}"
        if at > 1:
            first = ", ".join(f"CAST({n} AS FLOAT) AS {n}" for n in x)
            found.append(f"""SELECT {first}, round(y, 6) AS y, round(y_hat, 6) AS y_hat,
                (SELECT round_even(avg(error ** 2), 0) FROM e{at}) AS mse, epoch_us(event_time) / 1000000.0 AS time_stamp,
                {at} AS batch_id
                FROM e{at} QUALIFY row_number() OVER (ORDER BY event_time, event_id) = 1""")
    return with_parts(" UNION ALL ".join(found), "usable", "context", **parts)


def minibatch_sgd(steps: int = 4) -> str:
    """Weights of the linear model after steps on the parts of the table that a hash of the id makes."""
    learner, x = LinearLearner(), FEATURE_COLUMNS
    moments = ", ".join(f"avg({n}) AS a_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}" for n in x)
    scaled = ", ".join(f"({n} - a_{n}) / s_{n} AS z_{n}" for n in x)
    parts = {
        "m": f"SELECT {moments} FROM full_rows",
        "z": f"""SELECT y, {scaled}, ('0x' || md5('7:' || event_id)[1:8])::BIGINT % {steps} AS part FROM full_rows, m""",
        "w0": "SELECT " + ", ".join(f"0.0::DOUBLE AS w_{name}" for name in [*x, "bias"]),
    }
    for at in range(steps):
        rate = f"({learner.rate} / {at + 1} ** {learner.power}::DOUBLE)"
        parts[f"e{at}"] = f"""SELECT *, w_bias + {' + '.join(f'w_{n} * z_{n}' for n in x)} - y AS error
                              FROM z, w{at} WHERE part = {at}"""
        moved = [f"any_value(w_{n}) - {rate} * (avg(error * z_{n}) + {learner.penalty} * any_value(w_{n})) AS w_{n}" for n in x]
        parts[f"w{at + 1}"] = f"SELECT {', '.join(moved)}, any_value(w_bias) - {rate} * avg(error) AS w_bias FROM e{at}"
    rows = " UNION ALL ".join(f"SELECT '{name}' AS input, round(w_{short}, 6) AS weight FROM w{steps}"
                              for name, short in [*((n, n) for n in x), ("intercept", "bias")])
    return with_parts(rows, "full_rows", **parts)


def weather_leaves() -> str:
    leaves = {
        "hour": "string", "main.feels_like": "double", "main.humidity": "bigint", "main.pressure": "bigint",
        "main.temp": "double", "name": "string", "sys.country": "string", "wind.speed": "double",
    }
    return " UNION ALL ".join(
        f"SELECT '{path}' AS path, '{kind}' AS type, count(*) AS non_null FROM weather" for path, kind in leaves.items()
    )


PAIRS = [(a, b) for at, a in enumerate(PAIR_MEASURES) for b in PAIR_MEASURES[at + 1:]]
LONG_CITIES = [f"{prefix}_{city}" for city in ("paris", "ny") for prefix in MEASURES]


def long_weather(table: str, at: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {at}, '{name.split('_')[0]}' AS measure, '{name.split('_')[1]}' AS city, {name} AS value FROM {table}"
        for name in LONG_CITIES
    )


# Whole comments in one text.
SHOWN = """coalesce(string_agg(comm_id || ':' || CAST(comm_time_utc AS BIGINT) || ':' || comm_score || ':' || comm_body, ','
                 ORDER BY comm_time_utc, comm_id), '')"""
POSTS_LANDED = with_parts(
    f"""SELECT {HOUR_KEY} AS hour, post_id, 0 AS part, post_title, post_time, post_score, post_upvote, {SHOWN} AS comments
        FROM posts LEFT JOIN comments USING (post_id) GROUP BY ALL""", "posts", "comments"
)
POSTS_COMMENTS = with_parts(
    "SELECT post_id, comm_id, comm_body, comm_time_utc, comm_score FROM comments JOIN posts USING (post_id)", "comments", "posts")
COMMENTS_JSON = f"""'[' || coalesce(string_agg('{{"comm_id":"' || comm_id || '","comm_body":' || to_json(comm_body)
                   || ',"comm_time_utc":' || {JSON_TIME} || ',"comm_score":' || comm_score || '}}', ','
                   ORDER BY comm_time_utc, comm_id), '') || ']'"""
KEYED_COMMENTS = with_parts(
    """SELECT comm_id AS comment_id, comm_body AS comment_body, comm_time_utc AS comment_time,
              comm_score AS comment_score, post_id AS post_key FROM comments JOIN posts USING (post_id)""", "posts", "comments"
)

AVERAGES = """
    SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
           time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
           symbol, round(avg(price), 6) AS avg_price FROM {0} WHERE event_time IS NOT NULL GROUP BY ALL"""

CHECKS: dict[str, str] = {
    "parse_ticks": with_parts("SELECT symbol, price, event_time FROM parsed", "parsed"),
    "split_symbol": with_parts(f"SELECT event_id, symbol, {BASE}, {QUOTE} FROM ticks", "ticks"),
    "hour_key": with_parts("SELECT event_id, strftime(event_time, '%Y-%m-%d-%H') AS hour_key FROM ticks", "ticks"),
    "tumbling_avg": with_parts(AVERAGES.format("ticks"), "ticks"),
    "lag_features": with_parts(
        "SELECT event_id, symbol, price, price_1, price_2, round(currency_diff, 6) AS currency_diff FROM lags", "lags"
    ),
    "batch_delta": with_parts("SELECT *, round(price - previous_price, 6) AS y FROM deltas", "deltas"),
    "batch_price_stats": with_parts(
        """SELECT date_trunc('hour', event_time) AS hour, count(*) AS n, arg_min(price, event_time) AS first_price,
                  arg_max(price, event_time) AS last_price FROM ticks GROUP BY 1""", "ticks"
    ),
    "lag_features_no_id": with_parts(
        "SELECT event_id AS row, price_1, price_2, round(currency_diff, 6) AS currency_diff FROM lags", "lags"
    ),
    "batch_delta_no_id": with_parts(
        "SELECT event_id AS row, previous_price, round(price - previous_price, 6) AS y FROM deltas", "deltas"
    ),
    "batch_price_stats_no_id": with_parts(
        """SELECT date_trunc('hour', event_time) AS hour, count(*) AS n, arg_min(price, event_time) AS first_price,
                  arg_max(price, event_time) AS last_price FROM ticks GROUP BY 1""", "ticks"
    ),
    "lag_features_cut": with_parts(
        """SELECT event_id, lag(price, 1) OVER w AS price_1, lag(price, 2) OVER w AS price_2, lag(price, 3) OVER w AS price_3
           FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id)""", "ticks"
    ),
    "ticks_numbered_cut": with_parts(
        """SELECT round(price) AS price, event_id, row_number() OVER (ORDER BY round(price), event_id) - 1 AS row_no
           FROM ticks""", "ticks"
    ),
    "histogram_auto_narrowed": histogram("SELECT price AS v FROM ticks", AUTO_BINS, "ticks"),
    "filter_time_range": with_parts(
        f"SELECT symbol, price, event_time AS date FROM ticks WHERE event_time >= {START} AND event_time <= {END}", "ticks"
    ),
    "series_price": with_parts("SELECT event_time AS date, 'Price' AS series, price AS value FROM ticks", "ticks"),
    "series_price_hourly": with_parts(
        """SELECT date_trunc('hour', event_time) AS date, 'Price' AS series, round(avg(price), 6) AS value
           FROM ticks GROUP BY 1""", "ticks"
    ),
    "series_price_m4": with_parts(
        """SELECT DISTINCT symbol, "column", make_timestamp(p.t) AS event_time, p.v AS price FROM (
               SELECT symbol, "column", unnest([
                   min({'t': t, 'v': v}), max({'t': t, 'v': v}),
                   {'t': min({'v': v, 't': t}).t, 'v': min(v)}, {'t': -max({'v': v, 't': -t}).t, 'v': max(v)}]) AS p
               FROM (SELECT symbol, epoch_us(event_time) AS t, price AS v, (epoch_us(event_time) - low) // width AS "column"
                     FROM ticks, (SELECT min(epoch_us(event_time)) AS low,
                                         (max(epoch_us(event_time)) - min(epoch_us(event_time)) + 200) // 200 AS width FROM ticks))
               GROUP BY symbol, "column")""", "ticks"
    ),
    "ndjson_scan_good": with_parts(
        "SELECT symbol, price, event_time AS date FROM parsed WHERE price IS NOT NULL", "parsed"
    ),
    "ndjson_scan_bad": with_parts(
        """SELECT CASE WHEN event_id % 97 = 0 THEN '{bad' ELSE
                  '{"symbol":"' || symbol || '","price":"?","timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')
                  || '"}' END AS line,
                  CASE WHEN event_id % 97 <> 0 THEN symbol END AS symbol
           FROM ticks WHERE event_id % 97 = 0 OR event_id % 101 = 0""", "ticks"
    ),
    "posts_scan": POSTS_LANDED,
    "posts_scan_multiline": POSTS_LANDED,
    "posts_scan_split": POSTS_LANDED,
    "posts_scan_parts": with_parts(
        """SELECT post_id, comm_id, comm_body, comm_time_utc, comm_score,
                  row_number() OVER (PARTITION BY post_id ORDER BY comm_time_utc NULLS FIRST, comm_id NULLS FIRST,
                                     comm_score NULLS FIRST, comm_body NULLS FIRST) - 1 AS place, coalesce(n, 0) AS posts
           FROM keyed LEFT JOIN pulled USING (post_id)""", "comments", "posts",
        keyed="SELECT * REPLACE (CASE WHEN post_id IS NOT NULL THEN comm_id END AS comm_id) FROM comments",
        pulled="SELECT post_id, count(*) AS n FROM posts GROUP BY 1"),
    "comments_to_json_parts": POSTS_COMMENTS,
    "posts_nest_from_flat": with_parts(
        f"""SELECT p.post_id, 0 AS part, post_title, post_time, post_score, post_upvote, {SHOWN} AS comments
           FROM posts p LEFT JOIN comments c USING (post_id) GROUP BY ALL""", "posts", "comments"
    ),
    "posts_day_band": with_parts(
        """SELECT * FROM posts WHERE post_time >= (SELECT max(post_time) FROM posts) - 86400
           AND post_time <= (SELECT max(post_time) FROM posts)""", "posts"
    ),
    "newest_posts": with_parts(
        "SELECT post_id, post_title, post_time FROM posts ORDER BY post_time DESC, post_id LIMIT 1000", "posts"
    ),
    "comment_count": with_parts('SELECT post_id, count(*) AS "count" FROM comments JOIN posts USING (post_id) GROUP BY 1', "comments", "posts"),
    "comment_count_flat": with_parts('SELECT post_id, count(*) AS "count" FROM comments GROUP BY 1', "comments"),
    "comment_count_outer": with_parts(
        'SELECT p.post_id, count(c.comm_id) AS "count" FROM posts p LEFT JOIN comments c USING (post_id) GROUP BY 1',
        "posts", "comments",
    ),
    "comments_to_json": with_parts(
        f"""SELECT p.post_id, 0 AS part, {COMMENTS_JSON} AS comments_json
            FROM posts p LEFT JOIN comments c USING (post_id) GROUP BY 1""", "posts", "comments"
    ),
    "posts_join_comments": with_parts(
        """SELECT p.post_id, post_title, post_score, comm_id, comm_body, comm_score
           FROM posts p LEFT JOIN comments c USING (post_id)""", "posts", "comments"
    ),
    "drop_top3": with_parts(TOP_DROPPED, "comments"),
    "histogram_comment_count": histogram("SELECT count(*) AS v FROM comments GROUP BY post_id", "20", "comments"),
    "histogram_comm_score": histogram(f"SELECT comm_score AS v FROM ({TOP_DROPPED})", "20", "comments"),
    "histogram_auto": histogram("SELECT price AS v FROM ticks", AUTO_BINS, "ticks"),
    "file_audit": with_parts(
        f"SELECT {HOUR_KEY} AS hour, count(*) AS rows, true AS has_bytes, true AS has_time FROM posts GROUP BY 1", "posts"
    ),
    "hour_partition_overwrite": with_parts(
        f"""SELECT {HOUR_KEY} AS hour, post_id,
                   CAST(post_score + CASE WHEN post_time = (SELECT max(post_time) FROM posts) THEN 1000 ELSE 0 END AS INT)
                       AS post_score FROM posts""", "posts"
    ),
    "hour_as_of_version": with_parts(
        f"""SELECT as_of, hour, post_id, CAST(post_score + CASE WHEN changed THEN 1000 ELSE 0 END AS INTEGER) AS post_score,
                   CAST(CASE WHEN changed THEN 2 ELSE 1 END AS BIGINT) AS version
            FROM (SELECT *, as_of = 'now' AND hour = max(hour) OVER () AS changed
                  FROM (SELECT {HOUR_KEY} AS hour, * FROM posts), (VALUES ('first'), ('now')) AS v(as_of))""", "posts"
    ),
    "schema_profile": with_parts(weather_leaves(), "weather"),
    "lexicon_sentiment": with_parts(
        "SELECT * FROM turn_scored", "lexicon", turn_scored=scored("conversations", "conv_id, turn", "text")
    ),
    "phrase_sentiment": with_parts(
        "SELECT * FROM turn_scored", "lexicon",
        phrases=views.PHRASES,
        valued="SELECT * FROM lexicon UNION ALL SELECT replace(phrase, ' ', chr(8288)), valence FROM phrases",
        turn_scored=scored("conversations", "conv_id, turn", "text", "valued", with_phrases),
    ),
    "post_scores": with_parts("SELECT post_id, sentiment AS post_sentiment FROM post_scored", "post_scored"),
    "comment_scores": with_parts("SELECT * FROM comment_mood", "comment_mood"),
    "comment_scores_parts": with_parts("SELECT * FROM comment_mood", "comment_mood"),
    "hourly_sentiment": with_parts("SELECT hour, round(sentiment, 6) AS sentiment FROM moods", "moods"),
    "kv_row_cells": with_parts(
        """SELECT post_id, qualifier, value FROM (
               SELECT post_id, post_title AS "post_info:post_title", CAST(post_time AS VARCHAR) AS "post_info:post_time",
                      CAST(post_score AS VARCHAR) AS "post_info:post_score",
                      CAST(post_upvote AS VARCHAR) AS "post_info:post_upvote", comments_json AS "post_info:comments",
                      CAST(sentiment AS VARCHAR) AS "sentiment:post_sentiment",
                      CAST(comments_sentiment AS VARCHAR) AS "sentiment:comments_sentiment"
               FROM posts JOIN post_scored USING (post_id) JOIN comment_mood USING (post_id) JOIN json USING (post_id))
           UNPIVOT (value FOR qualifier IN (COLUMNS(* EXCLUDE (post_id))))""", "post_scored", "comment_mood", "comments",
        json=f"SELECT p.post_id, {COMMENTS_JSON} AS comments_json FROM posts p LEFT JOIN comments c USING (post_id) GROUP BY 1",
    ),
    "kv_scan_posts": with_parts(
        """SELECT post_id AS post_key, post_score, post_time, post_title, post_upvote, comments_sentiment,
                  sentiment AS post_sentiment
           FROM posts JOIN post_scored USING (post_id) JOIN comment_mood USING (post_id)""", "post_scored", "comment_mood"
    ),
    "kv_scan_comments": KEYED_COMMENTS,
    "kv_upsert_parts": KEYED_COMMENTS,
    "kv_upsert_latest": with_parts(
        """SELECT post_id, CAST(post_score + CASE WHEN CAST(post_id AS BIGINT) % 2 = 0 THEN 1000 ELSE 0 END AS INT) AS post_score,
                  CAST(CASE WHEN CAST(post_id AS BIGINT) % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version FROM posts""", "posts"
    ),
    "kv_compacted_scan": with_parts(
        """SELECT post_id, post_title,
                  CAST(CASE WHEN n % 14 = 0 THEN -post_score WHEN n % 2 = 0 THEN post_score ELSE post_score + 1000 END AS INTEGER)
                      AS post_score,
                  CAST(CASE WHEN n % 14 = 0 THEN 4 WHEN n % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
           FROM (SELECT *, CAST(post_id AS BIGINT) AS n FROM posts) WHERE (n % 7 <> 0 OR n % 14 = 0) AND n % 5 <> 1""", "posts"
    ),
    "weather_scan_hour": with_parts(
        """SELECT strftime(hour, '%Y-%m-%d-%H') AS hour,
                  CASE country WHEN 'FR' THEN 'Paris' WHEN 'GB' THEN 'London' WHEN 'JP' THEN 'Tokyo' WHEN 'PL' THEN 'Warsaw'
                               ELSE 'New York' END AS city_name,
                  country, round(temp - 273.15, 6) AS temperature, humidity, round(wind_speed, 6) AS wind_speed
           FROM weather WHERE hour = (SELECT max(hour) FROM weather)""", "weather"
    ),
    "weather_flatten": with_parts(
        """SELECT hour, CASE country WHEN 'FR' THEN 'Paris' WHEN 'GB' THEN 'London' WHEN 'JP' THEN 'Tokyo'
                                     WHEN 'PL' THEN 'Warsaw' ELSE 'New York' END AS city_name,
                  country, round(temp - 273.15, 6) AS temperature, humidity, round(wind_speed, 6) AS wind_speed
           FROM weather""", "weather"
    ),
    "weather_union_files": with_parts(
        """SELECT humidity, round(wind_speed, 6) AS wind_speed, pressure, round(temp, 6) AS temp,
                  round(feels_like, 6) AS feels_like FROM weather""", "weather"
    ),
    "weather_pivot": with_parts(
        f"SELECT hour, {', '.join(f'round({name}, 6) AS {name}' for name in WEATHER_COLUMNS)} FROM wide", "wide"
    ),
    "weather_unpivot": with_parts(
        f"SELECT hour, measure, city, round(value, 6) AS value FROM ({long_weather('wide', 'hour')})", "wide"
    ),
    "weather_pair_corr": with_parts(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 6) AS corr FROM weather""" for a, b in PAIRS
        ), "weather"
    ),
    "weather_pair_grid": with_parts(
        """SELECT l.measure AS "left", r.measure AS "right", l.bin AS left_bin, r.bin AS right_bin, count(*) AS count
           FROM put l JOIN put r ON l.row = r.row AND l.place < r.place GROUP BY ALL""",
        "weather",
        numbered_weather="SELECT row_number() OVER () AS row, * FROM weather",
        long_weather=" UNION ALL ".join(
            f"SELECT row, {at} AS place, '{name}' AS measure, CAST({name} AS DOUBLE) AS v FROM numbered_weather"
            for at, name in enumerate(PAIR_MEASURES)),
        put="""SELECT row, place, measure, least(CAST(floor((v - lo) / ((hi - lo) / 10)) AS BIGINT) + 1, 10) AS bin
               FROM (SELECT *, min(v) OVER (PARTITION BY place) AS lo, max(v) OVER (PARTITION BY place) AS hi FROM long_weather)""",
    ),
    "posts_schema_drift": with_parts(
        """SELECT field, types, widened, count(DISTINCT n % 3) AS folders, count(*) AS rows, drifts
           FROM (SELECT CAST(post_id AS BIGINT) AS n FROM posts WHERE post_id <> '0') JOIN
                (VALUES ('post_id', 'bigint,string', 'string', [0, 1, 2], true), ('post_title', 'string', 'string', [0, 1], true),
                        ('post_score', 'bigint,double,string', 'string', [0, 1, 2], true), ('post_upvote', 'double', 'double', [0], true),
                        ('pinned', 'boolean', 'boolean', [2], true), ('tags', 'array', 'string', [2], true))
                AS f(field, types, widened, producers, drifts) ON list_contains(producers, n % 3) GROUP BY ALL""", "posts"
    ),
    "weather_union_drift": with_parts(
        """SELECT strftime(hour, '%Y-%m-%d %H') AS hour, country, CAST(humidity AS VARCHAR) AS temp,
                  CASE WHEN NOT old THEN CAST(humidity AS BIGINT) END AS humidity,
                  pressure + CASE WHEN old THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS pressure,
                  CASE WHEN NOT old THEN CAST(pressure AS BIGINT) END AS gust
           FROM (SELECT *, dayofyear(hour) % 3 = 0 AS old FROM weather)""", "weather"
    ),
    "weather_histograms": " UNION ALL ".join(
        f"""SELECT * FROM ({histogram(f'SELECT CAST({name} AS DOUBLE) AS v FROM weather', AUTO_BINS, 'weather',
                                      label=f"'{name}' AS measure,")})"""
        for name in PAIR_MEASURES
    ),
    "forward_fill_hour": with_parts(
        f"""SELECT h.hour, u.series, round(u.value, 6) AS value
            FROM (SELECT DISTINCT date_trunc('hour', event_time) AS hour FROM ticks) h
            JOIN (SELECT * FROM context UNPIVOT INCLUDE NULLS (value FOR series IN ({', '.join(CONTEXT)}))) u USING (hour)""",
        "ticks", "context",
    ),
    "asof_hour_join": with_parts(
        f"""SELECT t.event_id, date_trunc('hour', t.event_time) AS hour, {', '.join(f'round(c.{n}, 6) AS {n}' for n in CONTEXT)}
            FROM ticks t ASOF LEFT JOIN context c ON date_trunc('hour', t.event_time) >= c.hour""", "ticks", "context"
    ),
    "forward_fill_ranges": with_parts(
        f"""SELECT h.hour, u.series, round(u.value, 6) AS value
            FROM (SELECT DISTINCT date_trunc('hour', event_time) AS hour FROM ticks) h
            JOIN (SELECT * FROM context UNPIVOT INCLUDE NULLS (value FOR series IN ({', '.join(CONTEXT)}))) u USING (hour)""",
        "ticks", "context",
    ),
    "asof_ticks_quotes": LAST_QUOTE,
    "asof_ticks_quotes_cut": LAST_QUOTE,
    "asof_next_quote": with_parts(
        """SELECT event_id, t.symbol, price, CASE WHEN near THEN quote_id END AS quote_id, CASE WHEN near THEN bid END AS bid
           FROM (SELECT t.*, q.quote_id, q.bid, q.quoted_at - t.event_time <= INTERVAL 10 MINUTE AS near
                 FROM trades t ASOF LEFT JOIN first_quotes q ON t.symbol = q.symbol AND t.event_time < q.quoted_at) t""",
        "trades", "first_quotes",
    ),
    "asof_nearest_quote": with_parts(
        """SELECT event_id, symbol, price,
                  CASE WHEN near_before AND (NOT near_after OR event_time - before_at <= after_at - event_time) THEN before_id
                       WHEN near_after THEN after_id END AS quote_id
           FROM (SELECT t.*, b.quote_id AS before_id, b.quoted_at AS before_at, a.quote_id AS after_id, a.quoted_at AS after_at,
                        coalesce(t.event_time - b.quoted_at <= INTERVAL 2 MINUTE, false) AS near_before,
                        coalesce(a.quoted_at - t.event_time <= INTERVAL 2 MINUTE, false) AS near_after
                 FROM trades t ASOF LEFT JOIN last_quotes b ON t.symbol = b.symbol AND t.event_time >= b.quoted_at
                 ASOF LEFT JOIN first_quotes a ON t.symbol = a.symbol AND t.event_time <= a.quoted_at) t""",
        "trades", "last_quotes", "first_quotes",
    ),
    "feature_table": with_parts("SELECT * FROM featured", "featured"),
    "feature_vector": with_parts(
        f"""SELECT event_id, CAST({len(FEATURE_COLUMNS)} AS BIGINT) AS width,
                   round({' + '.join(f'{name} * {at}' for at, name in enumerate(FEATURE_COLUMNS, 1))}, 6) AS dot
            FROM full_rows""", "full_rows"
    ),
    "results_append": with_parts(f"SELECT {RESULTS_LIST} FROM results", "results"),
    "results_scan": with_parts(f"SELECT {RESULTS_LIST} FROM results", "results"),
    "results_time_range": with_parts(
        f"""SELECT date, time_stamp, y, y_hat, mse, row_number() OVER (ORDER BY time_stamp) - 1 AS row_no
            FROM results WHERE date >= {START} AND date <= {END}""", "results"
    ),
    "results_time_bounds": with_parts("SELECT min(date) AS start_date, max(date) AS end_date FROM results", "results"),
    "batch_mse": with_parts("SELECT hour, mse, mse_exact FROM errors", "errors"),
    "series_prediction": with_parts(
        "SELECT date, 'True' AS series, y AS value FROM results UNION ALL SELECT date, 'Prediction', y_hat FROM results",
        "results",
    ),
    "series_mse": with_parts("SELECT date, 'Model MSE' AS series, mse AS value FROM results", "results"),
    "series_sentiment": with_parts("SELECT date, 'Sentiment' AS series, sentiment AS value FROM results", "results"),
    "series_weather": with_parts(long_weather("results", "date"), "results"),
    "sgd_first_step": sgd_weights(),
    "sgd_minibatch_steps": minibatch_sgd(),
    "mlp_step": network_step(),
    "model_state_latest": sgd_weights(", CAST(2 AS BIGINT) AS models, CAST(1 AS BIGINT) AS version, "
                                      "(SELECT count(*) FROM full_rows) AS seen"),
    "stream_parse_ticks": with_parts(f"SELECT symbol, price, event_time, {BASE}, {QUOTE} FROM parsed", "parsed"),
    "stream_from_latest": with_parts(
        """SELECT p.event_id, p.symbol, p.price, p.event_time FROM parsed p JOIN ticks t ON t.event_id = p.event_id
           WHERE epoch_us(t.event_time) >= (SELECT epoch_us(min(event_time)) + CAST(round_even(
               (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 3.0, 0) AS BIGINT) FROM ticks)""", "parsed", "ticks"
    ),
    "stream_parquet_roundtrip": with_parts(
        f"""SELECT event_id, symbol, price, event_time, {BASE}, {QUOTE},
                   CAST(event_time AS DATE) AS day FROM parsed""", "parsed"
    ),
    "stream_tumbling_avg": with_parts(AVERAGES.format("parsed"), "parsed"),
    "stream_tumbling_complete": with_parts(AVERAGES.format("parsed"), "parsed"),
    "stream_lag_features": with_parts(
        """SELECT event_id, symbol, price, lag(price, 1) OVER w AS price_1, lag(price, 2) OVER w AS price_2,
                  round(lag(price, 1) OVER w - lag(price, 2) OVER w, 6) AS currency_diff
           FROM usable WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id)""", "usable"
    ),
    "stream_lag_state": with_parts(
        """SELECT event_id, symbol, price, lag(price, 1) OVER w AS price_1, lag(price, 2) OVER w AS price_2,
                  round(lag(price, 1) OVER w - lag(price, 2) OVER w, 6) AS currency_diff
           FROM usable WINDOW w AS (PARTITION BY symbol ORDER BY event_time, event_id)""", "usable"
    ),
    "stream_prequential_sgd": online_sgd(),
    "stream_enrich_hour": with_parts(
        f"""SELECT t.event_id, date_trunc('hour', t.event_time) AS hour, {', '.join(f'round(c.{n}, 6) AS {n}' for n in CONTEXT)}
            FROM (SELECT * FROM parsed WHERE event_time IS NOT NULL) t
            ASOF LEFT JOIN context c ON date_trunc('hour', t.event_time) >= c.hour""", "parsed", "context"
    ),
}
