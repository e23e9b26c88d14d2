from .plans.pipeline import main

main()
