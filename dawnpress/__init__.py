"""dawnpress: news-digest analytics and corpus preparation on Spark DataFrames."""
