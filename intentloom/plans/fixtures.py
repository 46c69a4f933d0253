"""The derived views again, as independent SQL for the checks."""

from __future__ import annotations

CTES = {
    "samples": """select doc_id as sample_id, text, lang as label_name,
        case lang when 'de' then 0 when 'en' then 1 when 'es' then 2 else 3 end as label from documents""",
    "samples20": """select doc_id as sample_id, text, source as label_name,
        cast(substr(source, 4) as int) as label from documents""",
    "predictions": """select event_id as prediction_id, ts, user_id as client_id,
        case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2
             when 'signup' then 3 else 4 end as predicted_label,
        event_type as predicted_label_name,
        cast(regexp_extract(props, '([0-9]+)', 1) as double) / cast(100 as double) as confidence,
        value as latency_ms,
        case when event_type = 'error' then 500 else 200 end as status,
        case when user_id % 10 = 0 then 'GET' else 'POST' end as method,
        case event_type when 'purchase' then '/feedback' when 'signup' then '/batch' else '/predict' end as endpoint,
        concat(event_type, ' ', cast(user_id % 10 as varchar)) as text from events""",
    "ref_cur": """select *, case when ts < timestamp '2024-01-16 00:00:00' then 'ref' else 'cur' end as side
        from predictions""",
    "feedback": """select concat('fb', cast(event_id as varchar)) as feedback_id, event_id as prediction_id,
        cast(user_id % 12 as int) as correct_label,
        case when user_id % 12 = 3 then null else concat('name_', cast(user_id % 12 as varchar)) end
            as correct_label_name, props as comment, ts as created_at
        from events where event_type = 'error'""",
    "emb_long": """select vec_id, label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as d
        from embeddings""",
    "centers": "select label as c, d, avg(v) as m from emb_long group by 1, 2",
    "logit": """select e.vec_id, any_value(e.label) as label, t.c, -sum((e.v - t.m) * (e.v - t.m)) as z
        from emb_long e join centers t using (d) group by e.vec_id, t.c""",
    "scored": """select vec_id, any_value(label) as label, arg_min(c, {'a': -z, 'b': c}) as predicted_label,
        1 / sum(exp(z - top)) as confidence
        from (select *, max(z) over (partition by vec_id) as top from logit) group by vec_id""",
}
NEEDS = {
    "ref_cur": ["predictions"],
    "centers": ["emb_long"],
    "logit": ["emb_long", "centers"],
    "scored": ["emb_long", "centers", "logit"],
}


def with_views(body: str, *names: str) -> str:
    """``body`` after a WITH clause of the named views and what they build on.

    ``body`` may start with further ``name as (...)`` parts, each followed by a comma.
    """
    wanted = {n for name in names for n in [name, *NEEDS.get(name, [])]}
    head = ",\n".join(f"{n} as ({sql})" for n, sql in CTES.items() if n in wanted)
    if body.lstrip().startswith("select"):
        return f"with {head}\n{body}" if head else body
    return f"with recursive {head + ',' if head else ''}\n{body}"
