"""SQL twins of the queries, for an independent engine (shared views as common table expressions)."""

from __future__ import annotations

import re

VIEWS = {
    "frames": "SELECT conv_id AS episode_index, turn AS frame_index, role, text FROM conversations",
    "episodes": "SELECT episode_index, count(*) AS length FROM frames GROUP BY ALL",
    "subset_episodes": "SELECT 'src' || (episode_index % 20) AS subset, episode_index, length FROM episodes",
    "descriptors": """SELECT subset, n, n % 13 = 1 AS cut, CASE WHEN n % 9 = 5 THEN 'v2.0' ELSE 'v2.1' END AS version, n % 7 = 6 AS bare, CASE WHEN n % 11 = 8 THEN 0 ELSE n + 10 END AS chunks_size,
        CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END AS images FROM (SELECT DISTINCT source AS subset, CAST(substr(source, 4) AS INT) AS n FROM documents WHERE source IS NOT NULL)""",
    "described": """SELECT subset, n, images, chunks_size, CASE WHEN cut THEN 'no JSON object' WHEN version <> 'v2.1' THEN 'version ' || version WHEN bare THEN 'no features' WHEN chunks_size < 1 THEN 'no chunk size' END AS issue FROM descriptors""",
    "padding": """SELECT episode_index, camera, length AS frame_count, least(episode_index % m, length - 1) AS tail_missing_count,
        range(length - least(episode_index % m, length - 1), length) AS missing_frame_indices
        FROM episodes, (VALUES ('observation.images.depth_01', 3), ('observation.images.depth_02', 2)) AS c(camera, m)""",
    "media_counts": """SELECT p.episode_index, p.camera AS media_key, CASE WHEN p.episode_index % 5 = 0 THEN p.frame_count - s.trim_count
        WHEN p.episode_index % 11 = 0 THEN p.frame_count + 1 ELSE p.frame_count END AS frames
        FROM padding p JOIN (SELECT episode_index, max(tail_missing_count) AS trim_count FROM padding GROUP BY 1) s USING (episode_index)
        WHERE NOT (p.episode_index % 17 = 0 AND p.camera = 'observation.images.depth_02')""",
    "vecframes": "SELECT label AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, embedding AS observation_state FROM embeddings",
    "statframes": """SELECT episode_index, frame_index, CAST(observation_state AS DOUBLE[]) AS state, [frame_index / 10.0::DOUBLE] AS stamp, [CASE WHEN frame_index % 7 = 6 THEN 1.0 ELSE 0.0 END] AS done, [0.1, 64.1] AS constant, CAST(observation_state[1:4] AS DOUBLE[]) AS nested FROM vecframes""",
    "tall": """SELECT episode_index, feature, unnest(v) AS v, unnest(range(len(v))) AS dim FROM (
        SELECT episode_index, 'observation_state' AS feature, state AS v FROM statframes UNION ALL SELECT episode_index, 'timestamp', stamp FROM statframes UNION ALL SELECT episode_index, 'next.done', done FROM statframes
        UNION ALL SELECT episode_index, 'constant', constant FROM statframes UNION ALL SELECT episode_index, 'nested', nested FROM statframes)""",
    "tasks": """SELECT doc_id, source AS subset, printf('chunk-%03d', doc_id // 100) AS chunk,
        'observation.images.rgb_' || CASE lang WHEN 'en' THEN '01' WHEN 'fr' THEN '02' WHEN 'de' THEN '03' ELSE '04' END AS input_camera,
        printf('episode_%06d', doc_id) AS episode, n_chars AS input_size_bytes FROM documents""",
    "requests": """SELECT s_suppkey AS request_id, 'src' || (s_suppkey % 25) AS subset, CASE WHEN s_suppkey % 17 = 3 THEN '7-5' WHEN s_suppkey % 19 = 4 THEN ''
        ELSE (s_suppkey % 4) || ',' || (s_suppkey % 6) || '-' || (s_suppkey % 6 + 2) END AS chunks,
        CASE s_suppkey % 3 WHEN 0 THEN '01' WHEN 1 THEN 'rgb_02' ELSE 'observation.images.rgb_03' END AS camera FROM supplier""",
    "wanted": """SELECT DISTINCT request_id, subset, camera, printf('chunk-%03d', n) AS chunk FROM (
        SELECT request_id, subset, camera, request_id % 4 AS n FROM requests WHERE chunks NOT IN ('', '7-5') UNION ALL
        SELECT request_id, subset, camera, unnest(range(request_id % 6, request_id % 6 + 3)) FROM requests WHERE chunks NOT IN ('', '7-5'))""",
    "plans": """SELECT s_suppkey AS request_id, CASE WHEN s_suppkey % 25 % 2 = 1 THEN 'group/' ELSE '' END || 'src' || (s_suppkey % 25) AS subset,
        CASE WHEN s_suppkey % 11 = 7 THEN 'bad' ELSE CASE s_suppkey % 7 WHEN 1 THEN 'two' WHEN 2 THEN 'three' WHEN 3 THEN 'images' WHEN 5 THEN 'videos' WHEN 6 THEN 'mixed' END END AS kind,
        CASE WHEN s_suppkey % 13 = 5 THEN 'bad' WHEN s_suppkey % 3 <> 0 THEN 'some' END AS chunk_kind,
        CASE WHEN s_suppkey % 13 <> 5 AND s_suppkey % 3 <> 0 THEN list_sort(list_distinct([s_suppkey % 4, s_suppkey % 6, s_suppkey % 6 + 1, s_suppkey % 6 + 2])) END AS wanted FROM supplier""",
    "parsed": """SELECT request_id, subset, wanted, CASE kind WHEN 'two' THEN ['meta', 'data'] WHEN 'three' THEN ['videos/observation.images.rgb_01', 'meta']
        WHEN 'images' THEN ['images/observation.images.depth_01'] WHEN 'videos' THEN ['videos'] END AS mods,
        CASE WHEN kind = 'mixed' THEN 'all beside other modalities' WHEN kind = 'bad' THEN 'invalid modality' WHEN chunk_kind = 'bad' THEN 'invalid chunks' END AS invalid FROM plans""",
    "tree": """SELECT doc_id, subset, path, input_size_bytes AS bytes FROM (
        SELECT doc_id, g AS subset, input_size_bytes, unnest([g || '/videos/' || chunk || '/' || input_camera || '/' || episode || '.mp4',
            CASE WHEN doc_id % 3 = 0 THEN g || '/images/' || chunk || '/observation.images.depth_01/' || episode || '/frame_000000.png' END,
            CASE WHEN doc_id % 2 = 0 THEN g || '/data/' || chunk || '/' || episode || '.parquet' END,
            CASE WHEN doc_id % 4 = 1 THEN g || '/meta/stats/' || episode || '.json' END]) AS path FROM (
        SELECT *, CASE WHEN CAST(replace(subset, 'src', '') AS INT) % 2 = 1 THEN 'group/' || subset ELSE subset END AS g FROM tasks)) WHERE path IS NOT NULL""",
    "parts": "SELECT subset, path, string_split(substr(path, length(subset) + 2), '/') AS p FROM tree",
    "layout": """SELECT subset, p[1] AS root, coalesce(array_to_string(list_sort(list(DISTINCT TRY_CAST(substr(p[2], 7) AS INT)) FILTER (p[2] LIKE 'chunk-%')), ','), '') AS chunks FROM parts GROUP BY 1, 2""",
    "rooted": """SELECT subset, root, CASE WHEN chunks <> '' THEN CAST(string_split(chunks, ',') AS BIGINT[]) END AS available, row_number() OVER (PARTITION BY subset ORDER BY root) AS i FROM layout""",
    "modalities": """SELECT request_id, m.subset, path, m.i, m.root, nested, available, r.root IS NOT NULL AS there, unnest(CASE WHEN available IS NULL OR wanted IS NULL THEN [NULL] ELSE wanted END) AS n, wanted FROM (
        SELECT *, split_part(path, '/', 1) AS root, CASE WHEN contains(path, '/') THEN split_part(path, '/', 2) END AS nested FROM (
        SELECT request_id, subset, wanted, unnest(mods) AS path, generate_subscripts(mods, 1) AS i FROM parsed WHERE invalid IS NULL AND mods IS NOT NULL AND subset IN (SELECT subset FROM layout))) m
        LEFT JOIN rooted r ON r.subset = m.subset AND r.root = m.root""",
    "checked": """SELECT request_id, subset, 0 AS place, subset || '/**' AS pattern, NULL AS issue FROM parsed WHERE invalid IS NULL AND mods IS NULL AND wanted IS NULL AND subset IN (SELECT subset FROM layout)
        UNION ALL SELECT request_id, p.subset, i * 1000, p.subset || '/' || root || '/**', NULL FROM parsed p JOIN rooted r ON p.subset = r.subset WHERE invalid IS NULL AND mods IS NULL AND wanted IS NOT NULL AND available IS NULL
        UNION ALL SELECT request_id, subset, i * 1000 + n, subset || '/' || root || printf('/chunk-%03d/**', n), NULL FROM (
            SELECT request_id, p.subset, root, i, available, unnest(wanted) AS n FROM parsed p JOIN rooted r ON p.subset = r.subset WHERE invalid IS NULL AND mods IS NULL AND available IS NOT NULL) q WHERE list_contains(available, n)
        UNION ALL SELECT request_id, subset, NULL, NULL, 'missing chunk ' || n FROM (SELECT request_id, subset, unnest(wanted) AS n FROM parsed WHERE invalid IS NULL AND mods IS NULL AND subset IN (SELECT subset FROM layout)) q
            WHERE NOT EXISTS (SELECT 1 FROM rooted r WHERE r.subset = q.subset AND list_contains(r.available, q.n))
        UNION ALL SELECT request_id, subset, NULL, NULL, invalid FROM parsed WHERE invalid IS NOT NULL
        UNION ALL SELECT request_id, subset, NULL, NULL, 'unknown subset' FROM parsed WHERE invalid IS NULL AND subset NOT IN (SELECT subset FROM layout)
        UNION ALL SELECT request_id, subset, i * 1000 + coalesce(n, 0),
            CASE WHEN issue IS NULL THEN subset || '/' || root || CASE WHEN n IS NOT NULL THEN printf('/chunk-%03d', n) || coalesce('/' || nested, '') WHEN nested IS NOT NULL THEN '/chunk-*/' || nested ELSE '' END || '/**' END, issue FROM (
            SELECT *, CASE WHEN NOT there THEN 'no root ' || root WHEN nested IS NOT NULL AND available IS NULL THEN 'not chunked: ' || path
                WHEN n IS NOT NULL AND NOT list_contains(available, n) THEN 'missing chunk ' || n || ' in ' || root END AS issue FROM modalities)""",
    "unverified": """SELECT request_id, subset, 0 AS place, subset || '/**' AS pattern FROM parsed WHERE invalid IS NULL AND mods IS NULL AND wanted IS NULL
        UNION ALL SELECT request_id, subset, -1, subset || '/meta/**' FROM parsed WHERE invalid IS NULL AND mods IS NULL AND wanted IS NOT NULL
        UNION ALL SELECT request_id, subset, n, subset || printf('/*/chunk-%03d/**', n) FROM (SELECT request_id, subset, unnest(wanted) AS n FROM parsed WHERE invalid IS NULL AND mods IS NULL)
        UNION ALL SELECT request_id, subset, i * 1000 + coalesce(n, 0), subset || '/' || split_part(path, '/', 1) || CASE WHEN n IS NULL THEN '' ELSE printf('/chunk-%03d', n) || CASE WHEN contains(path, '/') THEN '/' || split_part(path, '/', 2) ELSE '' END END || '/**' FROM (
            SELECT *, unnest(CASE WHEN wanted IS NULL OR path = 'meta' THEN [NULL] ELSE wanted END) AS n FROM (SELECT request_id, subset, wanted, unnest(mods) AS path, generate_subscripts(mods, 1) AS i FROM parsed WHERE invalid IS NULL AND mods IS NOT NULL))""",
    "planned": "SELECT request_id, subset, pattern, row_number() OVER (PARTITION BY request_id, subset ORDER BY place) - 1 AS position FROM (SELECT request_id, subset, pattern, min(place) AS place FROM checked WHERE pattern IS NOT NULL GROUP BY 1, 2, 3)",
    "wanted_chunks": "SELECT DISTINCT subset, CAST(unnest(wanted) AS INT) AS chunk FROM plans",
    "root_chunks": "SELECT subset, root, CAST(unnest(available) AS INT) AS chunk FROM rooted",
    "globs": "SELECT DISTINCT subset, pattern, replace(replace(replace(replace(pattern, '.', '\\.'), '/**', '/@'), '*', '[^/]*'), '@', '.+') AS rx FROM planned",
    "sidecars": f"""SELECT l.doc_id, toxic = 1 AS quarantined, quality = 1 AND l.doc_id % 46 <> 31 AND l.doc_id % 28 <> 13 AND l.doc_id % 16 <> 9 AND l.doc_id % 22 <> 1
            AND (l.doc_id % 12 = 0 OR l.doc_id % 26 <> 1) AND (l.doc_id % 14 = 7 OR l.doc_id % 10 <> 0)
            AND CASE l.doc_id % 3 WHEN 1 THEN true WHEN 2 THEN false ELSE l.doc_id % 18 <> 12 AND l.doc_id % 30 <> 24 AND l.doc_id % 36 <> 18 AND l.doc_id % 24 <> 6 END AS complete
        FROM labels l JOIN documents d USING (doc_id)""",
    "ledger": """SELECT event_id, ts, user_id AS task, CASE event_type WHEN 'error' THEN 'process_crash' WHEN 'signup' THEN 'python_failure' ELSE 'resolved' END AS event
        FROM events WHERE event_type IN ('error', 'signup', 'purchase')""",
    "heartbeats": "SELECT user_id AS task, ts, event_id AS beat_id FROM events",
    "media": """SELECT p_partkey AS media_id, p_brand AS subset, p_size * 64 AS width, p_size * 36 AS height, CASE p_partkey % 4 WHEN 0 THEN '10/1' WHEN 1 THEN '15/1' WHEN 2 THEN '30/1' ELSE '60/1' END AS avg_frame_rate FROM part""",
    "media_plans": """SELECT *, CAST(ceil(kept_frames / 16.0) AS BIGINT) AS batches, CASE WHEN kept_frames <= 14 THEN 1 ELSE CAST(ceil((kept_frames - 14) / 10.0) AS BIGINT) + 1 END AS windows FROM (
        SELECT *, CAST((ceil(out_width / 64.0) * 64 - out_width) // 2 AS BIGINT) AS pad_x, CAST((ceil(out_height / 64.0) * 64 - out_height) // 2 AS BIGINT) AS pad_y, CAST(ceil(rate * 20 / stride) AS BIGINT) AS kept_frames FROM (
        SELECT media_id, subset, CAST(round_even(width * sc, 0) AS BIGINT) AS out_width, CAST(round_even(height * sc, 0) AS BIGINT) AS out_height, rate, CAST(greatest(round_even(rate / 12, 0), 1) AS BIGINT) AS stride FROM (
        SELECT *, CASE WHEN greatest(width, height) > 1024 THEN 1024.0::DOUBLE / greatest(width, height) ELSE 1.0::DOUBLE END AS sc, CAST(split_part(avg_frame_rate, '/', 1) AS DOUBLE) / CAST(split_part(avg_frame_rate, '/', 2) AS DOUBLE) AS rate FROM media)))""",
    "specs": """SELECT episode_index, max(tail_missing_count) AS trim_count, min(frame_count) AS original_length,
        array_to_string(list_sort(list(DISTINCT camera)), ',') AS padded_cameras, min(frame_count) <> max(frame_count) AS conflict FROM padding WHERE tail_missing_count > 0 GROUP BY 1""",
    "trimmed": "SELECT f.* FROM frames f LEFT JOIN specs s USING (episode_index) WHERE s.trim_count IS NULL OR frame_index < original_length - trim_count",
    "paths": "SELECT subset, chunk, subset || '/videos/' || chunk || '/' || input_camera || '/' || episode || '.mp4' AS path, input_size_bytes AS bytes FROM tasks",
    "status": """SELECT t.*, coalesce(s.complete AND t.doc_id % 20 <> 19 AND t.doc_id % 34 <> 1, false) AS complete, coalesce(s.quarantined, false) AS quarantined FROM tasks t LEFT JOIN sidecars s USING (doc_id)""",
    "run": """SELECT *, CASE WHEN NOT complete AND NOT quarantined THEN CASE WHEN doc_id % 11 = 5 THEN 'locked' WHEN doc_id % 7 = 2 THEN 'failed' WHEN doc_id % 13 = 4 THEN 'skipped' ELSE 'complete' END END AS outcome FROM sharded""",
    "sharded": "SELECT *, row_number() OVER (ORDER BY subset, chunk, input_camera, episode) - 1 AS position, (row_number() OVER (ORDER BY subset, chunk, input_camera, episode) - 1) % 4 AS shard FROM status",
    "batched": "SELECT *, (row_number() OVER (PARTITION BY subset, chunk, input_camera ORDER BY episode) - 1) // 25 AS batch FROM tasks",
    "folded": """SELECT task, event_id, event, CAST(sum(CASE WHEN event = 'process_crash' THEN 1 ELSE 0 END) OVER (PARTITION BY task, part ORDER BY ts, event_id) AS BIGINT) AS attempts, ts FROM (
        SELECT *, sum(CASE WHEN event = 'process_crash' AND before = 'resolved' THEN 1 ELSE 0 END) OVER (PARTITION BY task ORDER BY ts, event_id) AS part FROM (
        SELECT *, lag(event) OVER (PARTITION BY task ORDER BY ts, event_id) AS before FROM ledger))""",
    "states": """SELECT task, event_id, event, attempts, CASE WHEN event = 'resolved' THEN 'resolved' WHEN event = 'python_failure' THEN 'quarantined' WHEN attempts >= 3 THEN 'quarantined' ELSE 'retrying' END AS status, ts FROM folded""",
    "sizes": "SELECT episode_index, count(*) AS n FROM frames GROUP BY 1",
    "sessions": """SELECT task, ts, beat_id, sum(new) OVER (PARTITION BY task ORDER BY ts, beat_id) AS session FROM (
        SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY task ORDER BY ts, beat_id) <= 900000000 THEN 0 ELSE 1 END AS new FROM heartbeats)""",
}


def sql(body: str) -> str:
    """`body` behind the views it uses."""
    need: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b(?:FROM|JOIN|IN \(SELECT \w+ FROM)\s+{name}\b", text) and name not in need:
                add(VIEWS[name])
                need.append(name)

    add(body)
    return (f"WITH {', '.join(f'{n} AS ({VIEWS[n]})' for n in need)} " if need else "") + body
