"""Fixed values that results depend on."""

# --- fixed values: provider codes -------------------------------------------------
PROVIDER_WEB = "BIS"
PROVIDER_SOCIAL = "BISSocial"
PROVIDER_PLAYON = "PlayOn"
PROVIDER_CTV = "AVOD BISCTV"

# --- fixed values: scopes and statuses --------------------------------------------
COUNTRY_US = "US"
ACTIVE = "ACTIVE"
ACTIVE_PROPERTY_STATUS = 92
MATCH_TYPE_MAP = "Map"
ADVERT = "Advert"
NON_AD = "NonAd"
BAD_AD = "BadAd"
HOLD = "Hold"
NOT_HOLD = "Not Hold"
SOURCE_NEW = "1-RawOccurrence"
SOURCE_HELD = "2-IntermediateStaging"
CODING_COMPLETED = "Coding Completed"

# --- fixed values: defaults -------------------------------------------------------
UNSPECIFIED_MARKET_ID = 302
UNSPECIFIED_MARKET_NAME = "~NOT SPECIFIED"
CTV_MEDIA_ID = 30
DIGITAL_MEDIA_ID = 5
CREATIVE_ID_START = 26_000_000_000
OCCURRENCE_ID_START = 75_000_000_000
COMPANY_LEVEL_PARENT = 3
COMPANY_LEVEL_SUBSIDIARY = 2
COMPANY_LEGACY_EXCLUDED = 9999
FIRST_SEEN_PROVIDER_IDS = [2, 11, 13, 16, 18]

# --- fixed values: landed-event whitelist -----------------------------------------
RAW_CREATIVE_TYPE = "video"
RAW_MIME_TYPE = "video/mp4"
RAW_PUBLISHER_IDS = [
    32734360, 33434701, 2945144, 2786484, 43838908, 38149324,
    11019659, 29528950, 2947526, 29321129, 204389,
]

# --- fixed values: MIME normalisation ---------------------------------------------
VIDEO_CHANNELS = ["desktop video", "mobile video", "desktop video-panel", "social video"]
SOCIAL_DISPLAY_CHANNEL = "social display"
MIME_CAROUSEL = "carousel"
MIME_VIDEO = "evaliant/video"
MIME_RICHMEDIA = "evaliant/richmedia"
MIME_JSON = "application/json"
MIME_OCTET_STREAM = "application/octet-stream"
MIME_DEFAULT_IMAGE = "image/jpeg"
MIME_BY_EXTENSION = {
    "bm": "image/bmp",
    "bmp": "image/bmp",
    "jpe": "image/jpeg",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "png": "image/png",
    "tiff": "image/tiff",
}

# --- fixed values: patterns and formats -------------------------------------------
URL_HOST_PATTERN = r"^(?:https?://)?(?:[@\n]+@)?(?:www.)?([^:/\n?]+)"
URL_VALID_PATTERN = r"^(https?://)([\w.-]+)(:[0-9]+)?(/.*)?$"
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CAPTURE_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"

# --- fixed values: creative scoring -----------------------------------------------
SIZE_TOLERANCE = 10
SIZE_ID_EXCLUDED = 5
SCORE_SIZE = 30
SCORE_TYPE = {"html5": 1500, "flash": 330}
SCORE_SERVER = 500
SCORE_AD_PATH = 150
SCORE_CONTENT_PATH = -150
SCORE_CLICK_SAME_HOST = 160
SCORE_CLICK_OTHER_HOST = 300
SCORE_THRESHOLD = 315
SCORED_TYPES = ["html5", "flash", "banner", "BANNER"]
AD_PATHS = ["/ad/", "/ads/", "/campaign/", "/campaigns/", "/promotional/", "/sponsor/"]
CONTENT_PATH = "/content/"
VIDEO_SECONDS = (2, 220)
VIDEO_SECONDS_DEFAULT = 30

# --- fixed values: duration buckets (low, high, label) ----------------------------
DURATION_BUCKETS = [
    (1, 10, "1-10 seconds"),
    (11, 15, "11-15 seconds"),
    (16, 30, "16-30 seconds"),
    (31, 45, "31-45 seconds"),
    (46, 60, "46-60 seconds"),
    (61, None, "> 60 seconds"),
]

# --- fixed values: code systems of the product map --------------------------------
SYSTEM_VX1 = "1"
SYSTEM_VX2 = "2"

# --- fixed values: classification hold --------------------------------------------
HOLD_EXEMPT_PROVIDER_IDS = [2, 19]
HOLD_URL_PROVIDER_IDS = [16, 18]
HOLD_ALWAYS_PROVIDER_IDS = [11, 13, 18]
HOLD_SCORED_PROVIDER_ID = 16
CLASS_ADVERT = 1
SETTLED_CLASS_IDS = [2, 3, 4]
SETTLED_ATTRIBUTION_IDS = [2, 3, 4]
STEP_MANUAL = 3
STEP_ENGINE = 5
ENGINE_ANSWERED = 1
ENGINE_FAILED_IDS = [2, 3]

# --- fixed values: gold creative columns a later sync changes ----------------------
UPDATED_COLUMNS = """
creative_duration creative_duration_bucket creative_tier_id primary_product_id vx1_product_id vx2_product_id
mr_company_id secondary_products vx1_secondary_products vx2_secondary_products mr_secondary_company_ids
primary_language_code classification_type classified_by_user_id classification_comments classified_timestamp
updated_timestamp classification_process_step creative_title creative_headline attribution_first_audio
attribution_lead_text attribution_visual attribution_summary attribution_other_details attribution_description
attribution_hashtag attribution_competitor attribution_celebrity attribution_slogan_tagline
attribution_revision_description attribution_comments attribution_creative_tags custom_attributes
attribution_timestamp attribution_by_user_id attribution_status is_sponsored_video is_component_eligible
component_entry_status component_entry_by_user_id component_entry_timestamp additional_multi_product_flag
additional_coop_product_flag send_to_adscope_unattributed first_seen_media first_seen_provider_occurrence_id
first_seen_occurrence_id first_seen_occurrence_timestamp first_seen_provider_code first_seen_media_property_id
first_seen_media_property_name first_seen_media_category_id first_seen_media_category_code
first_seen_provider_creative_link_url first_seen_provider_publisher_id first_seen_provider_publisher_domain
first_seen_provider_campaign_id first_seen_provider_campaign_name first_seen_provider_advertiser_id
first_seen_provider_advertiser_name first_seen_provider_product_id first_seen_provider_product_name
first_seen_provider_campaign_landing_page first_seen_market_id first_seen_market_name first_seen_daypart_id
first_seen_daypart_name first_seen_affiliate_id first_seen_affiliate_name due_timestamp last_seen_timestamp
print_ad_nli print_ad_equ print_ad_cost print_ad_size print_null_cost_comments print_los_id print_ad_type_id
print_ad_col_inch print_ad_weighted_col_inch print_recalculate_cost print_matching_ads print_ad_images
is_resegment product_mapping_status is_reclassified print_no_cost attribution_competitor_vx2 creative_payload
machine_learning_payload
""".split()

# --- fixed values: gold creative fields in the change log --------------------------
LOGGED_COLUMNS = """
creative_duration creative_duration_bucket creative_tier_id primary_language_code primary_product_id vx1_product_id
vx2_product_id secondary_products vx1_secondary_products vx2_secondary_products classification_type
classified_by_user_id classification_comments classified_timestamp classification_process_step creative_title
creative_headline attribution_first_audio attribution_lead_text attribution_visual attribution_summary
attribution_other_details attribution_description attribution_hashtag attribution_competitor attribution_celebrity
attribution_slogan_tagline attribution_revision_description attribution_comments attribution_creative_tags
custom_attributes attribution_timestamp attribution_by_user_id attribution_status is_component_eligible
component_entry_status component_entry_by_user_id component_entry_timestamp additional_multi_product_flag
additional_coop_product_flag send_to_adscope_unattributed first_seen_media first_seen_provider_occurrence_id
first_seen_occurrence_id first_seen_occurrence_timestamp first_seen_provider_code first_seen_media_property_id
first_seen_media_property_name first_seen_media_category_id first_seen_media_category_code
first_seen_provider_creative_link_url first_seen_provider_publisher_id first_seen_provider_publisher_domain
first_seen_provider_campaign_id first_seen_provider_campaign_name first_seen_provider_advertiser_id
first_seen_provider_advertiser_name first_seen_provider_product_id first_seen_provider_product_name
first_seen_market_id first_seen_market_name first_seen_daypart_id first_seen_daypart_name first_seen_affiliate_id
first_seen_affiliate_name due_timestamp last_seen_timestamp attribution_competitor_vx2 occurrence_description
legacy_creative_id creative_payload machine_learning_payload is_resegment product_mapping_status is_reclassified
""".split()

#: the end of holds that no timeout ends
NO_END = "9999-01-01 00:00:00"
