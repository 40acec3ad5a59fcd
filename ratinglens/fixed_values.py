"""Every constant whose exact value is part of the results.

Labels, thresholds, limits and patterns below have to keep these values (and this French wording) for
results to match what users of the tables and dashboards already read.
"""

# --- fixed values: limits -----------------------------------------------------------------------
RECENT_DAYS = 90                 # "recent" = the 90 days before the as-of date, and later
REPLAY_BATCH_SIZE = 500          # reviews per replay batch
TOP_REVIEWERS = 10               # reviewers listed per business
MAX_COMPETITORS = 50             # competitors mapped per business
COMPARED_COMPETITORS = 10        # competitors kept for the detailed comparison
SIDE_BY_SIDE = 5                 # competitors shown next to the business itself
DEFAULT_COMPETITOR_LIST = 20     # competitor list length unless asked otherwise
MARKET_VIEW_ROWS = 10            # rows of the market-share view
MIN_MARKET_REVIEWS = 100         # smaller markets have no share report
MIN_ACTIVE_REVIEWS = 5           # activity filter
MIN_QUARTERS = 3                 # trend needs this many periods, and compares this many at each end
TREND_STEP = 0.2                 # rating change that counts as a trend
SHORT_NAME_LENGTH = 20           # longer names are cut and get SHORT_NAME_SUFFIX
SHORT_NAME_SUFFIX = "..."
TOP_WORDS = 100                  # words kept per business
MIN_CLOUD_CHARS = 10             # less cleaned text than this gives no word list

# --- fixed values: trend labels -----------------------------------------------------------------
TREND_UP = "amélioration"
TREND_DOWN = "dégradation"
TREND_FLAT = "stable"

# --- fixed values: market position by average percentile, first match wins ---------------------------
POSITION_TIERS = [
    (80, "Leader du marché"),
    (60, "Bien positionné"),
    (40, "Position moyenne"),
]
POSITION_OTHERWISE = "À améliorer"
POSITION_UNKNOWN = "Non déterminé"

# --- fixed values: strengths and weaknesses -----------------------------------------------------
HIGH_PERCENTILE = 70
MIDDLE_PERCENTILE = 50
LOW_PERCENTILE = 30
FEW_LOCAL_RIVALS = 5
MANY_LOCAL_RIVALS = 20
STRENGTH_RATING = "Excellence des notes"
STRENGTH_POPULARITY = "Forte popularité"
STRENGTH_LOCAL = "Faible concurrence locale"
WEAKNESS_RATING = "Notes inférieures à la moyenne"
WEAKNESS_POPULARITY = "Faible visibilité"
WEAKNESS_LOCAL = "Forte concurrence locale"
LABEL_SEPARATOR = ", "
LABEL_TRIM_PATTERN = "^, |, $"

# --- fixed values: insights -----------------------------------------------------------------------
CROWDED_MARKET = 30
OPEN_LOCAL_MARKET = 3
RATING_EDGE = 0.5
POPULARITY_EDGE = 2
LOCAL_SHARE_EDGE = 0.3
INSIGHT_LEADER = "Leader du marché avec excellence sur tous les fronts"
INSIGHT_HIDDEN_QUALITY = "Excellente qualité mais manque de visibilité"
INSIGHT_VISIBLE_WEAK = "Forte visibilité mais qualité à améliorer"
INSIGHT_LOCAL = "Avantage concurrentiel géographique"
INSIGHT_CROWDED = "Marché très concurrentiel"
INSIGHT_OTHERWISE = "Position à consolider"
ACTION_QUALITY = "Priorité: Améliorer la satisfaction client et la qualité du service"
ACTION_VISIBILITY = "Priorité: Augmenter la visibilité et encourager les avis clients"
ACTION_LOCAL = "Opportunité: Dominer le marché local"
ACTION_OTHERWISE = "Maintenir les standards et surveiller la concurrence"
ADVANTAGE_QUALITY = "Avantage qualité significatif"
ADVANTAGE_POPULARITY = "Avantage popularité significatif"
ADVANTAGE_LOCAL = "Avantage géographique"
ADVANTAGE_OTHERWISE = "Aucun avantage concurrentiel majeur identifié"

# --- fixed values: dashboard wording ------------------------------------------------------------
TARGET_SUFFIX = " (Vous)"
RATING_TIERS = [(70, "Excellente position"), (50, "Position correcte")]
RATING_TIER_OTHERWISE = "Marge d'amélioration"
POPULARITY_TIERS = [(70, "Forte visibilité"), (50, "Visibilité correcte")]
POPULARITY_TIER_OTHERWISE = "Besoin de visibilité"
PLAN_QUALITY = "🎯 **Améliorer la qualité** : Se concentrer sur l'expérience client"
PLAN_NEGATIVE = "📝 **Analyser les avis négatifs** : Identifier les points de friction"
PLAN_VISIBILITY = "📢 **Augmenter la visibilité** : Encourager les clients satisfaits à laisser des avis"
PLAN_LOCAL_MARKETING = "🔍 **Marketing local** : Renforcer la présence dans la zone géographique"
PLAN_GEOGRAPHY = "🌍 **Exploiter l'avantage géographique** : Peu de concurrence directe dans votre ville"
PLAN_LEADER = "📈 **Rattraper le leader** : Analyser les meilleures pratiques du concurrent le mieux noté"
PLAN_OTHERWISE = "✅ **Maintenir l'excellence** : Continuer sur la voie actuelle et surveiller la concurrence"
GAP_BEHIND = "Écart avec le leader"
GAP_AHEAD = "Avance sur les concurrents"
STATUS_OPEN = "🟢 Ouvert"
STATUS_CLOSED = "🔴 Fermé"
FLAG_YES = "✅"
FLAG_NO = "❌"
COMPETITOR_TABLE_HEADINGS = {
    "competitor_name": "Nom",
    "competitor_city": "Ville",
    "competitor_average_rating": "Note moyenne",
    "competitor_recent_average": "Tendance récente",
    "competitor_total_reviews": "Nb avis",
    "is_same_city": "Même ville",
}

# --- fixed values: word cleaning ------------------------------------------------------------------
NON_LETTER_RUN = "[^a-zA-ZÀ-ÿ]+"
NON_LETTER_OR_SPACE = r"[^a-zA-ZÀ-ÿ\s]"
MIN_WORD_LETTERS = 2
# words of the review domain that are never counted
DOMAIN_STOP_WORDS = """
    restaurant place food eat go get really
    good great nice time back come went
    one two would could also much well
    like love want need think know see
    make take give way say come go
""".split()
# short general English list of our own; pass another one where a different base list is wanted
ENGLISH_STOP_WORDS = """
    about after again all am an and any are as at be because been before being below between both but by
    can did do does doing down during each few for from further had has have having he her here hers him
    his how if in into is it its just me more most my no nor not now of off on once only or other our out
    over own same she so some such than that the their them then there these they this those through to too
    under until up very was we were what when where which while who whom why will with you your
""".split()

# --- fixed values: date layouts -------------------------------------------------------------------
DATE_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
PERIOD_TYPES = ["month", "quarter", "year"]
