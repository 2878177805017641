"""Schemas of the inputs and outputs."""

ITEM = (
    "struct<type:string,page_idx:int,bbox:array<int>,text:string,table_body:string,html:string,"
    "table_caption:array<string>,image_caption:array<string>,img_path:string>"
)
PAGES = "struct<pdf_info:array<struct<page_idx:int,page_size:array<double>>>,_backend:string,_version_name:string>"

ENTITY = (
    "struct<entity_id:string,type:string,value:string,value_num:double,unit:string,value_pair:array<double>,"
    "span:array<int>,normalized:string,canonical_id:string>"
)
RELATION = (
    "struct<relation_id:string,type:string,source_entity_id:string,target_entity_id:string,confidence:double,"
    "rule:string,distance:int,sentence_id:string>"
)
BLOCK = (
    "struct<block_id:string,type:string,text:string,char_offset:array<int>,section:string,subsection:string,"
    "example_id:string,depends_on:array<int>,claim_no:int,table_id:string,table_no:string,figure_id:string,"
    f"figure_no:string,entities:array<{ENTITY}>,relations:array<{RELATION}>>"
)
EXPERIMENT = (
    "struct<example_id:string,materials_used:array<string>,performance:array<string>,"
    "performance_relations:array<string>,role_relations:array<string>,source_block_ids:array<string>>"
)
METADATA = (
    "struct<publication_number:string,publication_date:string,application_number:string,application_date:string,"
    "priority:array<string>,title:string,applicants:array<string>,inventors:array<string>,ipc:array<string>,"
    "cpc:array<string>,source:string>"
)
DOCUMENT = (
    f"doc_id string, source_file string, abstract string, metadata {METADATA}, blocks array<{BLOCK}>, "
    f"reference_numerals map<string,string>, experiments array<{EXPERIMENT}>"
)
LEDGER = (
    "file string, lang string, time string, status string, error_msg string, parser_version string, "
    "lang_source string, table_fallback_used boolean, done_with_warnings boolean, warnings string"
)
