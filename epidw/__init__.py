"""epidw: a Spark-native warehouse and analytics library for epidemiological notifications."""
