"""Schemas of the logical tables, as DDL."""

SEEDS = "seed_url string"
PAGES = "page_id bigint, url string, html string"
PAGE_STORE = "url string, final_url string, html string, cleaned_html string, success boolean"
LINKS = "source_url string, href string, text string, kind string, pos int"
FRONTIER = "seed string, url string, source_url string, depth int"
ELEMENT = "struct<pos:int,parent:int,end:int,depth:int,tag:string,attrs:map<string,string>,text_join:string,text_space:string,string:string>"
CRAWL_RESULTS = "seed string, html string, cleaned_html string, url string, depth int, debug_info array<string>, is_job_listing boolean, job_listing_score double, job_listing_metadata string"
CHUNKS = "page_key string, chunk_idx int, start bigint, chunk string"
NEXT_PAGE = "struct<text:string,href:string,selector:string>"
JOB_LINK_SPEC = "struct<href:string,text:string,selector:string>"
LISTING_SPEC = (
    f"is_job_listing boolean, score double, has_pagination boolean, parent_container_selector string, next_page_element {NEXT_PAGE}, "
    f"individual_job_links array<{JOB_LINK_SPEC}>, child_job_link_selector string, total_token_count bigint, careers_url string"
)
CHUNK_RESPONSE = f"page_key string, chunk_idx int, {LISTING_SPEC}"
JOB_LINKS = "title string, url string"
JOB_DETAILS = "jobtitle string, location string, required_skills string, compensation string, salary string, benefits string, total_token_count bigint"
CRAWL_RUNS = "id string, started_at timestamp, finished_at timestamp, seed_url string, status string, meta string"
HTML_BLOBS = "content_sha256 string, source_url string, byte_length bigint, storage_uri string"
JOBS = "id string, run_id string, listing_url string, job_url string, title string, location string, extracted string, created_at timestamp"
STAGE_EVENTS = "run_id string, stage string, duration_ms double, seed string, url string, tokens bigint, extra string"
MESSAGES = "session_id string, turn bigint, role string, content string"
USAGE = "input_tokens bigint, output_tokens bigint, total_tokens bigint"
