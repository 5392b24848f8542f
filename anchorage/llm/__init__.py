"""Operations of a training-data pipeline: each works on whole tables and whole texts."""
