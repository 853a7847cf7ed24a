"""The sources that are split into categories."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Site folder -> categories.
SITE_CATEGORIES = {
    "cointelegraph": ["bitcoin", "ethereum", "altcoin", "blockchain", "defi", "regulation", "business",
                      "nft", "ai", "adoption"],
    "coindesk": ["markets", "business", "policy", "tech", "opinion", "consensus-magazine", "learn"],
    "news.bitcoin": ["market-updates", "finance", "economics", "blockchain", "markets-and-prices", "mining",
                     "news-bytes", "regulation", "legal", "learning-insights"],
    "cryptoflies": ["nft-news", "metaverse-news", "crypto", "memecoin-news", "web3", "press-release"],
    "nftgators": ["web3", "nft-news", "industry", "onchain", "learn", "blockchain-games", "collectibles",
                  "metaverse", "interviews"],
    "droomdroom": ["adoption", "bitcoin", "altcoin", "nfts", "defi", "dao", "metaverse", "regulation",
                   "future-of-web3", "winners-of-web3"],
    "nonfungible": ["analysis", "art", "collectible", "corporate", "defi", "game", "metaverse", "opinions",
                    "utility"],
}


def site_categories(spark: SparkSession) -> DataFrame:
    pairs = [F.struct(F.lit(site).alias("site"), F.lit(category).alias("category"))
             for site, names in SITE_CATEGORIES.items() for category in names]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def batch_globs(root: str, *sites: str) -> list:
    """Where the batch files of the sites lie: one glob per category, or one for a site without any."""
    return [f"{root}/{site}/{category}/*.json" if category else f"{root}/{site}/*.json"
            for site in sites for category in SITE_CATEGORIES.get(site, [""])]
