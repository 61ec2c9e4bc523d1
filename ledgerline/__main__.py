from ledgerline.plans.run import main

main()
