"""Names that rows carry. Fixed values."""

VIEW_EVENTS = ["_page_view", "_screen_view"]
FIRST_OPEN = "_first_open"
FIRST_VISIT = "_first_visit"
PROFILE_SET = "_profile_set"
SESSION_START = "_session_start"
USER_ENGAGEMENT = "_user_engagement"
APP_EXCEPTION = "_app_exception"
APP_START = "_app_start"
APP_END = "_app_end"
SCROLL = "_scroll"
DIRECT = "Direct"

# Events that may carry a session's traffic source.
SESSION_EVENTS = ["_session_start", "_page_view", "_user_engagement", "_screen_view", "_app_end"]
# Events that may carry a user's first-touch fields.
FIRST_TOUCH_EVENTS = ["_first_open", "_first_visit", "_session_start", "_screen_view"]

# Event names the SDKs send on their own; open-ended paths leave them out.
BUILTIN_EVENTS = [
    "_session_start", "_session_stop", "_screen_view", "_app_exception",
    "_app_update", "_first_open", "_os_update", "_user_engagement",
    "_profile_set", "_page_view", "_app_start", "_scroll", "_search", "_click",
    "_clickstream_error", "_mp_share", "_mp_favorite", "_app_end",
]

TRAFFIC_FIELDS = [
    "source", "medium", "campaign", "content", "term",
    "campaign_id", "clid_platform", "clid", "channel_group", "category",
]
