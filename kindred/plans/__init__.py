"""Multi-step jobs: identity unification and the stage pipelines."""
