from tickwright.app import main

main()
