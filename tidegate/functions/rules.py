"""The row rules of each entity, as SQL text used on every side of a check."""

SALES_RULES = {
    "lineitem": {
        "valid_orderkey": "l_orderkey IS NOT NULL",
        "valid_linenumber": "l_linenumber IS NOT NULL",
        "valid_quantity": "l_quantity > 0",
        "valid_discount": "l_discount BETWEEN 0 AND 1",
        "valid_extendedprice": "l_extendedprice >= 0",
        "valid_tax": "l_tax >= 0",
    },
    "part": {"valid_partkey": "p_partkey IS NOT NULL", "valid_retailprice": "p_retailprice >= 0"},
    "supplier": {"valid_suppkey": "s_suppkey IS NOT NULL"},
    "partsupp": {
        "valid_partkey": "ps_partkey IS NOT NULL",
        "valid_suppkey": "ps_suppkey IS NOT NULL",
        "valid_availqty": "ps_availqty >= 0",
        "valid_supplycost": "ps_supplycost >= 0",
    },
    "nation": {"valid_nationkey": "n_nationkey IS NOT NULL"},
    "region": {"valid_regionkey": "r_regionkey IS NOT NULL"},
}

CAMPAIGN_RULES = {"valid_client_id": "client_id IS NOT NULL", "valid_budget": "budget >= 0"}

GAMING_RULES = {
    "players": {"valid_player_id": "player_id IS NOT NULL"},
    "sessions": {
        "valid_player_id": "player_id IS NOT NULL",
        "non_negative_duration": "duration_minutes >= 0",
    },
    "wagers": {
        "valid_player_id": "player_id IS NOT NULL",
        "positive_stake": "stake > 0",
        "non_negative_payout": "payout >= 0",
    },
    "deposits": {"valid_player_id": "player_id IS NOT NULL", "positive_amount": "amount > 0"},
    "licensees": {
        "valid_licensee_id": "licensee_id IS NOT NULL",
        "known_domain": "domain IN ('liquor', 'cannabis')",
    },
    "orders": {
        "valid_licensee_id": "licensee_id IS NOT NULL",
        "non_negative_amount": "amount >= 0",
        "positive_quantity": "quantity > 0",
    },
}

VALID_STAGES = ("new", "qualified", "won", "lost")
QUARANTINE_RATE_THRESHOLD = 0.10
REQUIRED_SOURCES = ("leads", "web_events", "ops_events")
