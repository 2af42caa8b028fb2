"""Credit-risk analytics as Spark jobs: curate, profile, train, score, publish."""
