"""Schemas of the corpus entities. Reading never infers: empty arrays would be taken for strings."""

from __future__ import annotations

SPAN = "start:INT,end:INT"
EDGE = "ARRAY<STRUCT<id:STRING,extraction:STRING,certainty:STRING,mention:STRING>>"
CHUNK = (
    "STRUCT<chunk_ref:STRING,page_ref:STRING,ordinal:INT,text:STRING,content_hash:STRING,kind:STRING,heading_source:STRING,heading_path:ARRAY<STRING>,"
    "fragment:STRUCT<index:INT,count:INT>,headings:ARRAY<STRUCT<level:INT,source:STRING,ref:STRING>>,"
    "blocks:ARRAY<STRUCT<kind:STRING,text:STRING,depth:INT,src:STRING,alt:STRING>>,"
    f"links:ARRAY<STRUCT<href:STRING,text:STRING,{SPAN}>>,emphasis:ARRAY<STRUCT<kind:STRING,text:STRING,{SPAN}>>,"
    "tables:ARRAY<STRUCT<ordinal:INT,rows:INT,columns:INT,header_row:INT,cells:ARRAY<ARRAY<STRUCT<text:STRING,colspan:INT,rowspan:INT>>>>>,"
    f"provisions:{EDGE},cases:ARRAY<STRUCT<id:STRING,citation:STRING>>,"
    "internal_refs:ARRAY<STRUCT<ref:STRING,extraction:STRING,certainty:STRING,mention:STRING>>>"
)
PAGE = (
    "STRUCT<page_ref:STRING,part_id:STRING,url:STRING,nav_title:STRING,h1:STRING,content_hash:STRING,date_published:STRING,last_amended:STRING,amendment_note:STRING,"
    "extractor_version:STRING,crawled_at:STRING,archived:BOOLEAN,printed_page_ref:STRING,images:ARRAY<STRUCT<src:STRING,alt:STRING>>,amendments:ARRAY<STRUCT<date:STRING,reason:STRING>>>"
)
PAGE_FILE = f"page {PAGE}, chunks ARRAY<{CHUNK}>"
UNIT = (
    "STRUCT<ref:STRING,parent_ref:STRING,ordinal:INT,depth:INT,kind:STRING,style:STRING,number:STRING,text:STRING,content_hash:STRING,number_collision:BOOLEAN,"
    f"emphasis:ARRAY<STRUCT<text:STRING,{SPAN},weight:STRING>>,provisions:{EDGE},"
    "table:STRUCT<rows:ARRAY<ARRAY<STRUCT<text:STRING,colspan:INT,heading:BOOLEAN,continues:BOOLEAN>>>>>"
)
PROVISION = (
    "ref STRING, instrument STRING, kind STRING, number STRING, title STRING, containers ARRAY<STRING>, heading_path ARRAY<STRING>, text STRING, content_hash STRING, "
    f"captured_at STRING, extractor_version STRING, units ARRAY<{UNIT}>"
)
SITEMAP = (
    "parts ARRAY<STRUCT<part_id:STRING,part_title:STRING,page_count:INT>>, "
    "pages ARRAY<STRUCT<url:STRING,page_ref:STRING,part_id:STRING,part_title:STRING,nav_title:STRING,kind:STRING,nav_ordinal:INT>>"
)
RETIRED = "retired ARRAY<STRUCT<page_ref:STRING,part_id:STRING,retired_at:STRING,url:STRING>>"
CONTENTS = (
    "instrument STRING, containers ARRAY<STRUCT<ref:STRING,kind:STRING,number:STRING,title:STRING,parent_ref:STRING>>, "
    "provisions ARRAY<STRUCT<ref:STRING,kind:STRING,number:STRING,title:STRING,container_ref:STRING,ordinal:INT>>"
)
ENDNOTES = "instrument STRING, endnotes ARRAY<STRUCT<ref:STRING,number:INT,title:STRING,paragraphs:ARRAY<STRING>,tables:ARRAY<STRUCT<rows:ARRAY<ARRAY<STRING>>>>>>, captured_at STRING, extractor_version STRING"
INSTRUMENT = (
    "code STRING, title_id STRING, name STRING, symbol STRING, short_title STRING, long_title STRING, number_and_year STRING, made_under STRING, register_id STRING, "
    "compilation_number STRING, compilation_start STRING, status STRING, registered_at STRING, captured_at STRING, extractor_version STRING, has_unincorporated_amendments BOOLEAN, "
    "amendments ARRAY<STRUCT<affect:STRING,markdown:STRING,title_id:STRING,name:STRING,provisions:STRING,series_type:STRING,year:INT,number:INT>>, "
    "document STRUCT<format:STRING,content_hash:STRING,bytes:BIGINT>, counts STRUCT<containers:INT,provisions:INT,units:INT>"
)
MANIFEST = (
    "crawled_at STRING, finished_at STRING, extractor_version STRING, corpus STRUCT<chunks:INT,links:INT,pages:INT,parts:INT,raw_files:INT,raw_bytes:BIGINT,mean_raw_bytes:BIGINT>, "
    "run STRUCT<complete:BOOLEAN,force:BOOLEAN,from_raw:BOOLEAN,limit:INT,part:STRING,unreachable:ARRAY<STRUCT<page_ref:STRING,url:STRING,status:INT>>,refs_settled:ARRAY<STRING>,retired:ARRAY<STRING>,"
    "archived:INT,chunks_cut:INT,chunks_changed:INT,not_modified:INT,pages_fetched:INT,pages_in_scope:INT,pages_parsed:INT,pages_written:INT,raw_written:INT,skipped_not_modified:INT,unchanged:INT>, "
    "source STRUCT<manual_root:STRING,seed:STRING>"
)
FETCHED = "url STRING, status INT, html STRING, etag STRING, last_modified STRING"
FAILURE = "check STRING, where STRING, message STRING"
