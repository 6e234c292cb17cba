"""DuckDB SQL twins of the registered queries, by query name.

Common table expressions are kept by name in ``PARTS`` and each oracle lists the ones it needs,
in order. Queries whose result depends on a fitted model have no twin.
"""

from __future__ import annotations

from earshot.functions.hashing import threshold
from earshot.operators.bootstrap import DRAWS, poisson_thresholds
from earshot.operators.histories import PARTS as HISTORY_PARTS
from earshot.operators.models import TRAIN_SHARE
from earshot.operators.splits import TEST_SHARE, VALID_SHARE
from earshot.sources.tables import AUDIO, TIMBRE


def _hash(*keys: str) -> str:
    text = " || ':' || ".join(f"({k})::VARCHAR" for k in keys)
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def _index(source: str, key: str, index: str) -> str:
    return f"""
        SELECT {key}, count(*) AS freq,
               row_number() OVER (ORDER BY count(*) DESC, {key}::VARCHAR) - 1 AS {index}
        FROM {source} GROUP BY {key}"""


def _popular(source: str, score: str, k: int = 500) -> str:
    return f"""
        SELECT item_index, {score} AS score,
               row_number() OVER (ORDER BY {score} DESC, item_index) AS position
        FROM {source} GROUP BY item_index QUALIFY position <= {k}"""


def _neighbours(queries: str, items: str, k: int, having: str = "") -> str:
    return f"""
        SELECT q.id AS query_id, x.id AS id, list_distance(q.features, x.features) ** 2 AS score,
               row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.features, x.features), x.id) AS rank
        FROM {queries} q JOIN {items} x ON {having or 'true'} QUALIFY rank <= {k}"""


def _lists(users: str, items: str, k: int) -> str:
    return f"""
        SELECT u.id AS user_index, i.id AS item_index, list_inner_product(u.features, i.features) AS rating,
               row_number() OVER (PARTITION BY u.id
                                  ORDER BY list_inner_product(u.features, i.features) DESC, i.id) AS position
        FROM {users} u, {items} i QUALIFY position <= {k}"""


def _weight(*keys: str) -> str:
    """Poisson weight of a row in a draw, as hashed thresholds."""
    hashed = _hash("'bootstrap'", *keys)
    return f"len(list_filter({poisson_thresholds()}, lambda least: least <= {hashed}))"


def _interval(source: str, value: str, key: str) -> str:
    return f"""
        SELECT (SELECT count(*) FROM {source}) AS n, (SELECT round(avg({value}), 6) FROM {source}) AS mean,
               round(quantile_cont(resampled, 0.025), 6) AS low, round(quantile_cont(resampled, 0.975), 6) AS high
        FROM (SELECT draw, sum({value} * weight) / sum(weight) AS resampled
              FROM (SELECT *, {_weight("draw", key)} AS weight FROM {source}, range({DRAWS}) AS d(draw))
              WHERE weight > 0 GROUP BY draw)"""


_AUDIO_COLUMNS = ", ".join(f"embedding[{i + 1}]::DOUBLE AS {name}" for i, name in enumerate(AUDIO))
_INPUTS = [*TIMBRE, "loudness_std", "loudness_mean", "duration", "artist_hotttnesss", "artist_familiarity", "year"]

PARTS = {
    "inter": """
        SELECT o_custkey AS user_id, l_partkey AS track_id, sum(l_quantity) AS count
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    "spl": f"""
        SELECT *, CASE WHEN {_hash("'holdout-row'", "user_id", "track_id")} < {threshold(0.5)} THEN
                       CASE WHEN {_hash("'holdout-user'", "user_id")} < {threshold(VALID_SHARE)} THEN 'valid'
                            WHEN {_hash("'holdout-user'", "user_id")} < {threshold(VALID_SHARE + TEST_SHARE)} THEN 'test'
                            ELSE 'train' END
                       ELSE 'train' END AS split
        FROM inter""",
    "train": "SELECT * FROM spl WHERE split = 'train'",
    "uidx": _index("train", "user_id", "user_index"),
    "iidx": _index("train", "track_id", "item_index"),
    "indexed": """
        SELECT user_id, track_id, user_index, item_index, count, split
        FROM spl JOIN (SELECT user_id, user_index FROM uidx) USING (user_id)
                 JOIN (SELECT track_id, item_index FROM iidx) USING (track_id)""",
    "xtrain": "SELECT * EXCLUDE split FROM indexed WHERE split = 'train'",
    "labels": "SELECT user_index, item_index FROM indexed WHERE split = 'test'",
    "popular": _popular("xtrain", "count(*)"),
    "tags": """
        SELECT p_partkey AS track_id, unnest(string_split(p_name, ' ')) AS tag FROM part
        UNION ALL SELECT p_partkey, p_type FROM part""",
    "meta": """
        SELECT p_partkey AS track_id, p_brand AS artist_id, nullif(p_size, 13)::DOUBLE AS year,
               p_retailprice AS duration, (p_partkey % 89) / 88.0::DOUBLE AS artist_hotttnesss,
               (p_partkey % 101) / 100.0::DOUBLE AS artist_familiarity FROM part""",
    "audio": f"SELECT vec_id AS track_id, {_AUDIO_COLUMNS} FROM embeddings",
    "lyr": """
        SELECT track_id, word FROM (
          SELECT doc_id AS track_id, unnest(regexp_split_to_array(lower(text), '[\\x09-\\x0D\\x20]+')) AS word FROM documents)
        WHERE word <> ''""",
    "tagtf": "SELECT track_id, tag, count(*) AS tf FROM tags GROUP BY 1, 2",
    "lyrtf": "SELECT track_id, word, count(*) AS tf FROM lyr GROUP BY 1, 2",
    "tagvoc": """
        SELECT tag, sum(tf)::BIGINT AS total, count(*) AS items,
               row_number() OVER (ORDER BY sum(tf) DESC, tag) - 1 AS term_index
        FROM tagtf GROUP BY tag HAVING count(*) >= 2 QUALIFY term_index < 5000""",
    "lyrvoc": """
        SELECT word, row_number() OVER (ORDER BY sum(tf) DESC, word) - 1 AS term_index
        FROM lyrtf GROUP BY word HAVING count(*) >= 2""",
    "shortrows": f"""
        SELECT track_id, {', '.join(_INPUTS)} FROM meta JOIN audio USING (track_id)
        WHERE track_id IN (SELECT track_id FROM tags) AND track_id IN (SELECT track_id FROM lyr)""",
    "vec": "SELECT vec_id AS id, embedding::DOUBLE[] AS features, label FROM embeddings",
    "dims": """
        SELECT label AS cell, d, avg(v) AS v
        FROM (SELECT label, unnest(features) AS v, unnest(range(1, len(features) + 1)) AS d FROM vec)
        GROUP BY 1, 2""",
    "centres": "SELECT cell AS id, list(v ORDER BY d) AS features FROM dims GROUP BY cell",
    "assigned": "SELECT query_id AS id, c.id AS cell FROM (" + _neighbours("vec", "centres", 1) + ") c",
    "invec": "SELECT vec.id, features, cell FROM vec JOIN assigned USING (id)",
    "probes": "SELECT query_id, p.id AS cell, rank AS probe FROM (" + _neighbours("vec", "centres", 9) + ") p",
    "qcell": "SELECT vec.id, features, cell, probe FROM vec JOIN probes ON query_id = vec.id",
    "exact10": _neighbours("vec", "vec", 10),
    "exact50": _neighbours("vec", "vec", 50),
    "cand50": _neighbours("qcell", "invec", 50, "q.cell = x.cell AND q.probe <= 3"),
    "cold": f"SELECT id AS item_index, label FROM vec WHERE {_hash(chr(39) + 'cold-item' + chr(39), 'id')} < {threshold(0.2)}",
    "patched": """
        SELECT vec.id, CASE WHEN item_index IS NULL THEN vec.features ELSE centres.features END::FLOAT[] AS features
        FROM vec LEFT JOIN cold ON vec.id = item_index LEFT JOIN centres ON centres.id = cold.label""",
}

_SPLIT = ["inter", "spl"]
_TRAIN = [*_SPLIT, "train"]
_INDEXED = [*_TRAIN, "uidx", "iidx", "indexed"]
_POPULAR = [*_INDEXED, "xtrain", "labels", "popular"]
_IVF = ["vec", "dims", "centres", "assigned", "invec", "probes", "qcell"]


def _sql(parts: list[str], select: str, **extra: str) -> str:
    named = {**{p: PARTS[p] for p in parts}, **extra}
    if not named:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in named.items()) + "\n" + select


def _per_user(lists: str, labels: str, ks: tuple[int, ...] = (), by: str = "") -> str:
    """Metrics of every user who has both a list and labels; ``by`` is an extra list column."""
    lead = f"{by}, " if by else ""
    sums, columns = "", ""
    for k in ks:
        sums += f""",
            sum(nth / position) FILTER (position <= {k}) AS sum_{k},
            count(*) FILTER (position <= {k}) AS hits_{k},
            sum(1 / log2(position + 1)) FILTER (position <= {k}) AS dcg_{k}"""
        columns += f""",
            coalesce(sum_{k}, 0) / least(n_labels, {k}) AS ap_at_{k},
            coalesce(hits_{k}, 0) / {k} AS precision_at_{k},
            coalesce(hits_{k}, 0) / n_labels AS recall_at_{k},
            coalesce(dcg_{k}, 0) / list_sum([1 / log2(i + 1) FOR i IN range(1, least(n_labels, {k}) + 1)])
              AS ndcg_at_{k}"""
    join = f"USING ({lead}user_index)"
    return f"""
        SELECT {lead}user_index, n_labels, coalesce(hits, 0) AS hits, coalesce(sum_all, 0) / n_labels AS ap {columns}
        FROM (SELECT DISTINCT {lead}user_index FROM {lists})
        JOIN (SELECT user_index, count(DISTINCT item_index) AS n_labels FROM {labels} GROUP BY 1) USING (user_index)
        LEFT JOIN (
          SELECT {lead}user_index, sum(nth / position) AS sum_all, count(*) AS hits {sums}
          FROM (SELECT {lead}user_index, position,
                       row_number() OVER (PARTITION BY {lead}user_index ORDER BY position) AS nth
                FROM {lists} JOIN (SELECT DISTINCT user_index, item_index FROM {labels}) USING (user_index, item_index))
          GROUP BY ALL) {join}"""


def _means(labels: str, ks: tuple[int, ...] = (), by: str = "") -> str:
    """Means over the table ``per_user``."""
    lead = f"{by}, " if by else ""
    names = [f"{m}_at_{k}" for k in ks for m in ("map", "precision", "recall", "ndcg")]
    columns = "".join(f", round(avg({n.replace('map', 'ap')}), 6) AS {n}" for n in names)
    total = f"(SELECT count(DISTINCT user_index) FROM {labels})"
    return f"""
        SELECT {lead}round(avg(ap), 6) AS map {columns}, count(*) AS users,
               round(count(*) / {total}, 6) AS coverage, round(avg(ap) * count(*) / {total}, 6) AS map_all_users
        FROM per_user {f'GROUP BY {by}' if by else ''}"""


_EVERYONE = "SELECT user_index, item_index, score AS rating, position FROM popular, (SELECT DISTINCT user_index FROM {})"
_CUTOFFS = (10, 100, 500)

_BOARD_PARTS = {
    "listeners": _popular("xtrain", "count(*)::DOUBLE"),
    "plays": _popular("xtrain", "sum(count)"),
    "log_plays": _popular("(SELECT item_index, log10(count + 1) AS count FROM xtrain)", "sum(count)"),
    "repeat_listeners": _popular("(SELECT * FROM xtrain WHERE count > 1)", "count(*)::DOUBLE"),
}
_BOARD = _sql(
    _POPULAR,
    f"""SELECT row_number() OVER (ORDER BY list_position({list(_BOARD_PARTS)}, ranking)) - 1 AS position,
               ranking, map, users, coverage FROM ({_means('labels', by='ranking')})""",
    **_BOARD_PARTS,
    lists="SELECT ranking, user_index, item_index, position FROM ("
    + " UNION ALL ".join(f"SELECT '{name}' AS ranking, item_index, position FROM {name}" for name in _BOARD_PARTS)
    + "), (SELECT DISTINCT user_index FROM labels)",
    per_user=_per_user("lists", "labels", by="ranking"),
)

_FULL_ENTRIES = f"""
    SELECT track_id, {{}} FROM (
      SELECT track_id, unnest([{', '.join(f"{c}::DOUBLE" for c in _INPUTS)}]) AS value,
             unnest(range({len(_INPUTS)})) AS position FROM okrows
      UNION ALL SELECT track_id, tf::DOUBLE, {len(_INPUTS)} + term_index FROM lyrtf JOIN lyrvoc USING (word) SEMI JOIN okrows USING (track_id)
      UNION ALL SELECT track_id, tf::DOUBLE, {len(_INPUTS)} + (SELECT count(*) FROM lyrvoc) + term_index FROM tagtf JOIN tagvoc USING (tag) SEMI JOIN okrows USING (track_id))
"""

ORACLES = {
    "interactions": _sql(["inter"], "SELECT * FROM inter"),
    "interaction_summary": _sql(
        ["inter"],
        "SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT track_id) AS items, sum(count) AS plays FROM inter",
    ),
    "user_index": _sql([*_TRAIN, "uidx"], "SELECT * FROM uidx"),
    "item_index": _sql([*_TRAIN, "iidx"], "SELECT * FROM iidx"),
    "indexed_interactions": _sql(_INDEXED, "SELECT * FROM indexed"),
    "side_table_index": _sql(
        [*_TRAIN, "iidx", "tags"], "SELECT track_id, tag, item_index FROM tags JOIN iidx USING (track_id)"
    ),
    "artist_index": _sql(
        ["meta"],
        "SELECT track_id, artist_id, artist_idx FROM meta JOIN artists USING (artist_id)",
        artists=_index("meta", "artist_id", "artist_idx"),
    ),
    "log_counts": _sql(
        [*_INDEXED, "xtrain"], "SELECT user_index, item_index, round(log10(count + 1), 6) AS count FROM xtrain"
    ),
    "drop_low_counts": _sql([*_INDEXED, "xtrain"], "SELECT * FROM xtrain WHERE count > 1"),
    "item_clustered_export": _sql(
        [*_TRAIN, "iidx", "tags"], "SELECT track_id, tag, item_index FROM tags JOIN iidx USING (track_id)"
    ),
    "csv_matrix": _sql(
        ["vec"],
        """SELECT id, unnest(range(len(features))) AS dim, round(unnest(features), 6) AS value FROM vec""",
    ),
    "hash_sample": _sql(
        ["inter"],
        f"SELECT * FROM inter WHERE {_hash(chr(39) + 'sample' + chr(39), 'user_id', 'track_id')} < {threshold(TRAIN_SHARE)}",
    ),
    "holdout_split": _sql(_SPLIT, "SELECT * FROM spl"),
    "downsample_eval_users": _sql(
        _TRAIN,
        f"""SELECT user_id, track_id, count FROM train
            WHERE user_id IN (SELECT user_id FROM spl WHERE split <> 'train')
               OR {_hash("'sample'", 'user_id', 'track_id')} < {threshold(TRAIN_SHARE)}""",
    ),
    "item_holdout": _sql(
        ["inter"],
        f"""SELECT *, CASE WHEN {_hash("'cold-item'", 'track_id')} < {threshold(0.2)} THEN 'cold' ELSE 'kept' END AS part
            FROM inter""",
    ),
    "query_sample": _sql(
        ["vec"], f"""SELECT id, label::BIGINT AS label FROM vec ORDER BY {_hash("'query'", 'id')}, id LIMIT 50"""
    ),
    "eval_users_in_train": _sql(
        _TRAIN,
        """SELECT user_id, count(*) AS visible, sum(count) AS plays FROM train
           WHERE user_id IN (SELECT user_id FROM spl WHERE split <> 'train') GROUP BY 1""",
    ),
    "user_histories": _sql(
        [*_INDEXED, "xtrain", "labels"],
        f"""SELECT user_index, {_hash("'part'", 'item_index')} % {HISTORY_PARTS} AS part,
                   count(DISTINCT item_index) AS n_labels,
                   array_to_string(list_sort(list(DISTINCT item_index)), ',') AS label FROM labels GROUP BY 1, 2""",
    ),
    "popularity_top_k": _sql(_POPULAR, "SELECT item_index, score, position FROM popular"),
    "recommended_items": _sql(
        _POPULAR,
        """SELECT user_index, position - 1 AS at, item_index
           FROM popular, (SELECT DISTINCT user_index FROM indexed WHERE split = 'valid')""",
    ),
    "map_popularity": _sql(
        _POPULAR, _means("labels"), lists=_EVERYONE.format("labels"), per_user=_per_user("lists", "labels")
    ),
    "ranking_metrics": _sql(
        _POPULAR,
        _means("labels", _CUTOFFS),
        lists=_EVERYONE.format("labels"),
        per_user=_per_user("lists", "labels", _CUTOFFS),
    ),
    "user_average_precision": _sql(
        _POPULAR,
        "SELECT user_index, n_labels, hits, round(ap, 6) AS ap FROM per_user",
        lists=_EVERYONE.format("labels"),
        per_user=_per_user("lists", "labels"),
    ),
    "popularity_leaderboard": _BOARD,
    "leaderboard_best": _BOARD + " ORDER BY map DESC, position LIMIT 1",
    "top_k_factors": _sql(
        ["vec"],
        "SELECT user_index, item_index, round(rating, 6) AS rating, position FROM lists",
        lists=_lists("vec", "vec", 100),
    ),
    "top_k_unseen": _sql(
        ["vec", *_INDEXED, "xtrain"],
        """SELECT user_index, item_index, round(rating, 6) AS rating,
                  row_number() OVER (PARTITION BY user_index ORDER BY rating DESC, item_index) AS position
           FROM (SELECT u.id AS user_index, i.id AS item_index, list_inner_product(u.features, i.features) AS rating
                 FROM vec u, vec i)
           ANTI JOIN xtrain USING (user_index, item_index) QUALIFY position <= 100""",
    ),
    "map_factors": _sql(
        ["vec", *_INDEXED, "xtrain", "labels"],
        _means("labels", _CUTOFFS),
        asking="SELECT * FROM vec WHERE id IN (SELECT user_index FROM labels)",
        lists=_lists("asking", "vec", 500),
        per_user=_per_user("lists", "labels", _CUTOFFS),
    ),
    "count_variant_rows": _sql(
        [*_INDEXED, "xtrain"],
        """SELECT 'index' AS variant, count(*) AS n, round(sum(count), 3) AS weight FROM xtrain
           UNION ALL SELECT 'log', count(*), round(sum(log10(count + 1)), 3) FROM xtrain
           UNION ALL SELECT 'drop', count(*), round(sum(count), 3) FROM xtrain WHERE count > 1""",
    ),
    "knn_exact": _sql(["vec", "exact10"], "SELECT query_id, id, round(score, 6) AS score, rank FROM exact10"),
    "ivf_assign": _sql(_IVF[:4], "SELECT id, cell::BIGINT AS cell FROM assigned"),
    "ivf_search": _sql(
        _IVF,
        "SELECT query_id, id, round(score, 6) AS score, rank FROM found",
        found=_neighbours("qcell", "invec", 10, "q.cell = x.cell AND q.probe <= 3"),
    ),
    "profile_neighbours": _sql(
        ["inter"],
        f"SELECT query_id, id, round(score) AS score, rank FROM ({_neighbours('profiles', 'profiles', 10)})",
        profiles="""
            SELECT user_id AS id, [count(*), sum(count), max(count), min(count)]::DOUBLE[] AS features
            FROM inter GROUP BY user_id""",
    ),
    "bootstrap_weights": _sql(
        ["vec"],
        f"SELECT id, draw, weight FROM (SELECT id, draw, {_weight('draw', 'id')} AS weight FROM vec, range(10) AS d(draw)) WHERE weight > 0",
    ),
    "recall_interval": _sql(
        [*_IVF, "exact10", "cand50"],
        _interval("per_query", "recall", "query_id"),
        per_query="""
            SELECT e.query_id, round(count(c.id) / count(*), 6) AS recall
            FROM exact10 e LEFT JOIN cand50 c USING (query_id, id) GROUP BY 1""",
    ),
    "map_interval": _sql(
        _POPULAR,
        _interval("precision_of_users", "ap", "user_index"),
        lists=_EVERYONE.format("labels"),
        per_user=_per_user("lists", "labels"),
        precision_of_users="SELECT user_index, round(ap, 6) AS ap FROM per_user",
    ),
    "recall_per_query": _sql(
        [*_IVF, "exact10", "cand50"],
        """SELECT e.query_id, count(c.id) AS found, count(*) AS wanted, round(count(c.id) / count(*), 6) AS recall
           FROM exact10 e LEFT JOIN cand50 c USING (query_id, id) GROUP BY 1""",
    ),
    "recall_sweep": _sql(
        [*_IVF, "exact10"],
        """SELECT m AS multiplier, count(*) AS queries, round(avg(recall), 6) AS recall FROM (
             SELECT ms.m, e.query_id, count(c.id) / count(*) AS recall
             FROM exact10 e, ms LEFT JOIN cand c ON c.query_id = e.query_id AND c.id = e.id AND c.m = ms.m
             GROUP BY ALL) GROUP BY m""",
        ms="SELECT unnest(range(1, 10)) AS m",
        cand="""
            SELECT m, q.id AS query_id, x.id AS id,
                   row_number() OVER (PARTITION BY m, q.id ORDER BY list_distance(q.features, x.features), x.id) AS rank
            FROM ms JOIN qcell q ON q.probe <= m JOIN invec x ON q.cell = x.cell QUALIFY rank <= 10 * m""",
    ),
    "recall_growing_truth": _sql(
        [*_IVF, "exact50", "cand50"],
        """SELECT m AS multiplier, count(*) AS queries, round(avg(recall), 6) AS recall FROM (
             SELECT m, e.query_id, count(c.id) / count(*) AS recall
             FROM exact50 e JOIN ms ON e.rank <= 10 * m
             LEFT JOIN cand50 c ON c.query_id = e.query_id AND c.id = e.id AND c.rank <= 10 * m
             GROUP BY ALL) GROUP BY m""",
        ms="SELECT unnest([1, 5])::BIGINT AS m",
    ),
    "tag_vocabulary": _sql(["tags", "tagtf", "tagvoc"], "SELECT * FROM tagvoc"),
    "tag_counts": _sql(
        ["tags", "tagtf", "tagvoc"], "SELECT track_id, tag, tf, term_index FROM tagtf JOIN tagvoc USING (tag)"
    ),
    "item_tags": _sql(
        ["tags", "tagtf"],
        f"""SELECT track_id, {_hash("'part'", 'tag')} % {HISTORY_PARTS} AS part,
                   string_agg(tag || '=' || tf, ',' ORDER BY tag) AS tags FROM tagtf GROUP BY 1, 2""",
    ),
    "frequent_tags": _sql(
        ["tags"], "SELECT tag, count(*) AS n FROM tags GROUP BY 1 HAVING count(*) >= 100"
    ),
    "tags_marked_frequent": _sql(
        ["tags"],
        """SELECT t.track_id, t.tag, (f.tag IS NOT NULL)::BIGINT AS is_frequent FROM tags t
           LEFT JOIN (SELECT tag FROM tags GROUP BY 1 HAVING count(*) >= 100) f USING (tag)""",
    ),
    "lyrics_bag_of_words": _sql(["lyr", "lyrtf"], "SELECT * FROM lyrtf"),
    "item_features": _sql(
        ["tags", "meta", "audio", "lyr"],
        f"""SELECT track_id, artist_idx, n_tags, n_words, {', '.join(f'round({c}, 6) AS {c}' for c in _INPUTS)}
            FROM meta JOIN artists USING (artist_id) JOIN audio USING (track_id)
            JOIN (SELECT track_id, count(*) AS n_tags FROM tags GROUP BY 1) USING (track_id)
            JOIN (SELECT track_id, count(*) AS n_words FROM lyr GROUP BY 1) USING (track_id)""",
        artists=_index("meta", "artist_id", "artist_idx"),
    ),
    "item_preview": _sql(
        ["meta", "audio"],
        "SELECT track_id, artist_id, duration FROM meta JOIN audio USING (track_id) ORDER BY track_id LIMIT 5",
    ),
    "scaled_features": _sql(
        ["tags", "meta", "audio", "lyr", "shortrows"],
        "SELECT track_id, "
        + ", ".join(f"round(coalesce({c} / nullif(stddev_samp({c}) OVER (), 0), 0), 6) AS {c}" for c in _INPUTS)
        + " FROM shortrows WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in _INPUTS),
    ),
    "full_features": _sql(
        ["tags", "meta", "audio", "lyr", "tagtf", "lyrtf", "tagvoc", "lyrvoc", "shortrows"],
        """SELECT track_id, position, round(value / sqrt((sq - s * s / n) / (n - 1)), 6) AS value
           FROM entries JOIN (SELECT position, sum(value * value) AS sq, sum(value) AS s, (SELECT count(*) FROM okrows) AS n
                              FROM entries GROUP BY 1) USING (position)
           WHERE value <> 0 AND (sq - s * s / n) > 1e-9""",
        okrows="SELECT * FROM shortrows WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _INPUTS),
        entries=_FULL_ENTRIES.format("value, position::BIGINT AS position"),
    ),
    "classifier_error": _sql(
        _IVF[:4],
        """SELECT count(*) FILTER (label <> cell) AS errors, count(*) AS n,
                  round(avg((label <> cell)::INT), 6) AS error_rate FROM vec JOIN assigned USING (id)""",
    ),
    "cluster_training_table": _sql(
        ["tags", "meta", "audio", "lyr", "shortrows", "vec"],
        f"""SELECT track_id, duration, year, label::BIGINT AS label,
                   CASE WHEN {_hash("'cold-item'", 'track_id')} < {threshold(0.2)} THEN 'test' ELSE 'train' END AS part
            FROM shortrows JOIN vec ON vec.id = track_id""",
    ),
    "patch_factors": _sql(
        ["vec", "dims", "centres", "cold", "patched"],
        """SELECT id, unnest(range(len(features))) AS dim, round(unnest(features)::DOUBLE, 5) AS value FROM patched""",
    ),
    "versioned_factors": _sql(
        ["vec", "dims", "centres", "cold", "patched"],
        """SELECT version, id, unnest(range(len(features))) AS dim, round(unnest(features)::FLOAT::DOUBLE, 5) AS value
           FROM (SELECT '1' AS version, id, features::DOUBLE[] AS features FROM vec
                 UNION ALL SELECT '2', id, features::DOUBLE[] FROM patched)""",
    ),
    "als_saved_factors": _sql(
        [*_INDEXED, "xtrain"],
        """SELECT side, CASE side WHEN 'user' THEN users ELSE items END AS n, 5 AS rank
           FROM (SELECT count(DISTINCT user_index) AS users, count(DISTINCT item_index) AS items FROM xtrain),
                (SELECT unnest(['loaded items', 'item', 'user']) AS side)""",
    ),
    "cold_vs_full": _sql(
        [*_INDEXED, "xtrain", "labels", "vec", "dims", "centres", "cold", "patched"],
        _means("cold_labels", by="model"),
        cold_labels="SELECT labels.* FROM labels SEMI JOIN cold USING (item_index)",
        asking="SELECT * FROM vec WHERE id IN (SELECT user_index FROM cold_labels)",
        lists_full=_lists("asking", "vec", 100),
        lists_patched=_lists("asking", "(SELECT id, features::DOUBLE[] AS features FROM patched)", 100),
        lists="SELECT 'full' AS model, * FROM lists_full UNION ALL SELECT 'patched', * FROM lists_patched",
        per_user=_per_user("lists", "cold_labels", by="model"),
    ),
}
ORACLES["item_features_colocated"] = ORACLES["item_features"]
ORACLES["knn_bounded"] = ORACLES["knn_exact"]
ORACLES["log_counts_by_statement"] = ORACLES["log_counts"]
