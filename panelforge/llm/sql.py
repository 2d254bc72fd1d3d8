"""DuckDB SQL for the queries that SQL can express."""

MIX_SQL = r"""
with sized as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         ([3, 1, 2])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as w
  from sized group by source),
filled as (
  select *, source_size::double / w as ratio,
         (150 * sum(source_size) over ()
          - 200 * coalesce(sum(source_size) over (order by source_size::double / w, source nulls last
                                                  rows between unbounded preceding and 1 preceding), 0))::bigint as left100,
         (sum(w) over (order by source_size::double / w, source nulls last
                       rows between current row and unbounded following))::bigint as w_left
  from sources),
marked as (select *, 200 * source_size * w_left <= w * left100 as stops from filled),
level as (select left100, w_left from marked where not stops order by ratio, source nulls last limit 1),
targets as (
  select m.source, m.source_size,
         case when stops then (2 * source_size)::double
              else (w * (select left100 from level))::double / (100 * (select w_left from level))::double end as target
  from marked m),
placed as (
  select s.*, t.source_size, t.target, floor(t.target + 0.5)::bigint as budget,
         coalesce(sum(size) over (partition by s.source order by key, doc_id nulls last, size
                                  rows between unbounded preceding and 1 preceding), 0)::bigint as seen
  from sized s join targets t on s.source is not distinct from t.source),
cut as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from placed)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - seen)))::bigint as taken
from cut
"""
